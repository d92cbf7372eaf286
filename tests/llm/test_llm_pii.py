"""Pattern spans against the plain patterns, message passing against sums over
all labellings, and labels carried over a skip edge."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_help import SF, docs_frame
from ridelens.llm import pii as P

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = (
                True,
                kind != 1 or all(int(x) <= 255 for x in m[0].split(".")),
                kind != 2 or 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0,
                kind != 3 or 10 <= len(digits) <= 15,
            )
            if all(ok):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aé@.+-_ ()0123456789\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert P.base_spans(text) == brute(text)


def test_base_spans_on_awkward_texts():
    for text in ("a@b.c@d.e", "x@y.z_q@r.s", "1.2.3.4.5.6.7.8", "256.1.1.1", "007.1.1.1", "0000000300.1.1.1", "4556 7375 8689 9855 1", "+1 (555) 010-9999 4556737586899855", "é@x.y", "@a.b", "a@@b.c d@e", "+12", "1" * 5000, "a" * 5000 + "@", "@" * 2000):
        assert P.base_spans(text) == brute(text)


def test_nodes_are_the_tokens_with_a_digit_or_an_at(spark):
    text = "a1 b @ c(2) \tx\u00a0y3\nz 4"
    assert [m[0] for m in P._NODE.finditer(text)] == [x for x in re.split(r"[ \t-\r]+", text) if re.search("[0-9@]", x)]
    assert [m[0] for m in P._NODE.finditer("a (b) x(at)y [at] (at (at) ([at]")] == ["x(at)y", "[at]", "(at)", "([at]"]
    long = "a" * 2_000_000 + " 1 " + "(" * 500_000 + "@ " + "1." * 300_000
    graph = P.read_graph([(0, long, P.base_spans(long))])
    assert len(graph.labels) == 3


def test_message_passing_is_exact_on_a_tree():
    rng = np.random.default_rng(5)
    n, k = 5, len(P.KINDS) + 1
    graph = P.Graph(*(np.zeros(n, np.int64),) * 3, np.arange(n)[:, None], np.zeros(n, np.int64), np.zeros(n, bool), np.array([[0, 1], [1, 2]]), np.array([[1, 3], [0, 4]]))
    w = P.Weights(rng.normal(size=(n, k)), rng.normal(size=(k, k)), np.diag(rng.random(k)))
    unary = w.unary
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        value = sum(unary[i, x] for i, x in enumerate(labels))
        value += sum(w.near[labels[a], labels[b]] for a, b in graph.near) + sum(w.skip[labels[a], labels[b]] for a, b in graph.skip)
        for i, x in enumerate(labels):
            total[i, x] += np.exp(value)
    exact = total / total.sum(axis=1, keepdims=True)
    assert np.abs(P.posteriors(graph, w, iterations=80) - exact).max() < 1e-6


def test_skip_edges_tie_repeats_in_a_line():
    text = " ".join(["call 555-218-5021"] * 300)
    graph = P.read_graph([(0, text, [])])
    assert len(graph.labels) == 300 and len(graph.skip) == 299


def test_a_label_is_carried_to_a_similar_token():
    k = len(P.KINDS) + 1
    graph = P.read_graph([(0, "card 4556737586899855 again as no4556737586899855x and 17 here", [(5, 2, 21)])])
    assert graph.labels.tolist()[:2] == [2, k - 1] and [0, 1] in graph.skip.tolist()
    graph.features = np.arange(len(graph.labels))[:, None]  # a weight per node
    unary = np.zeros((len(graph.labels), k))
    unary[:, -1], unary[0, 2] = 1.0, 8.0
    alone = P.posteriors(graph, P.Weights(unary, np.zeros((k, k)), np.zeros((k, k))))
    tied = P.posteriors(graph, P.Weights(unary, np.zeros((k, k)), np.eye(k) * 6))
    assert alone[1, 2] < 0.3 and tied[1, 2] > 0.9 and tied[2, 2] < 0.3
    added = list(P.added_spans(graph, P.Weights(unary, np.zeros((k, k)), np.eye(k) * 6)))
    assert added == [(0, (31, 2, 50))]


def test_evidence_reaches_the_far_end_of_a_line():
    graph = P.read_graph([(0, " ".join(["call 555-218-5021"] * 300), [])])
    k, n = len(P.KINDS) + 1, len(graph.labels)
    graph.features = np.arange(n)[:, None]
    unary = np.zeros((n, k))
    unary[0, 2] = 50.0  # the one clear mention
    got = P.posteriors(graph, P.Weights(unary, np.zeros((k, k)), np.eye(k) * 6))[:, 2]
    fade = (np.exp(6) - 1) / (np.exp(6) + k - 1)  # a link's, exactly
    assert np.abs(got - (1 / k + (1 - 1 / k) * fade ** np.arange(n))).max() < 1e-6


def spans_text(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = P.op2_personal_data(spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs)
    for r in got:
        base = brute(docs[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(spans_text(base).encode()).hexdigest()
        assert set(spans_text(base).split(",")) <= set(r.spans.split(","))
        starts = [(int(x.split(":")[1]), P.KINDS.index(x.split(":")[0])) for x in r.spans.split(",") if x]
        assert starts == sorted(starts)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.de"), (3, "mail a.b@c.de"), (None, "é 1.2.3.4"), (4, "9" * 3_000_000)]
    df = docs_frame(spark, rows, extra=True)
    assert P.train(docs_frame(spark, [(1, "none here")])) is None and P.train(docs_frame(spark, [])) is None
    got = {}
    for r in P.find_personal_data(df, P.train(df)).collect():
        got.setdefault(r.doc_id, []).append([(s.start, s.end, s.kind, s.base) for s in r.spans])
    assert got[1] == [[]] and got[2] == [[]] and got[4] == [[]]
    assert got[3] == [[(5, 13, "email", True)]] * 2 and got[None] == [[(2, 9, "ip", True)]]
    assert P.find_personal_data(docs_frame(spark, []), None).count() == 0


def luhn_number(rng, n=16):
    while True:
        digits = "".join(str(rng.randrange(10)) for _ in range(n))
        if P.luhn(digits):
            return digits


def entity(rng, kind):
    n = lambda low, high: rng.randrange(low, high)
    name = "".join(rng.choice("abcdefgh") for _ in range(n(4, 8)))
    return {
        "email": lambda: f"{name}.{n(10, 99)}@{rng.choice(['mail', 'post7', 'example'])}.{rng.choice(['com', 'org'])}",
        "ip": lambda: ".".join(str(n(10, 255)) for _ in range(4)),
        "card": lambda: luhn_number(rng),
        "phone": lambda: f"+{n(1, 9)} ({n(100, 999)}) {n(100, 999)}-{n(1000, 9999)}",
        "secret": lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)),
    }[kind]()


CUES = {"email": ["mail", "write"], "ip": ["host", "server"], "card": ["card", "pay"], "phone": ["call", "phone"], "secret": ["token ="]}
WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy".split()


def planted(rng, i, damaged):
    """(text, [(kind, damaged entity)]): prose with ordinary numbers, whole entities and, if asked, damaged ones."""
    words, gone = [], []
    for _ in range(6):
        words += [rng.choice(WORDS) for _ in range(rng.randrange(3, 9))]
        words.append(rng.choice([str(rng.randrange(2030)), f"{rng.randrange(99)}%", f"{rng.randrange(9)}.{rng.randrange(9)}", "the", "No. 7", "10:45"]))
        words += [rng.choice(WORDS)]
        kind = rng.choice(list(CUES))
        whole = entity(rng, kind)
        cue = rng.choice(CUES[kind])
        if not damaged:
            words += [cue, whole]
            continue
        broken = {
            "email": lambda w=whole: rng.choice([w.replace("@", "(at)"), w.rpartition(".")[0]]),
            "ip": lambda w=whole: w.rpartition(".")[0] + "." + str(rng.randrange(256, 999)),
            "phone": lambda w=whole: w[w.find("(") :],
            "card": lambda w=whole: ".".join(w[i : i + 4] for i in range(0, 16, 4)),
            "secret": lambda w=whole: w,
        }[kind]()
        if kind in ("card", "secret"):  # a second mention, spelled another way or without its name
            words += [cue, whole, *rng.sample(WORDS, 3), "see"]
        else:
            words.append(cue)
        words.append(broken)
        gone.append((kind, broken))
    return " ".join([*words, "end"]), gone


def test_damaged_entities_are_found_and_ordinary_numbers_left_alone(spark):
    rng = random.Random(11)
    train = docs_frame(spark, [(i, planted(rng, i, False)[0]) for i in range(400)])
    weights = P.train(train)
    texts = [planted(rng, i, True) for i in range(200)]
    got = P.find_personal_data(docs_frame(spark, [(i, t) for i, (t, _) in enumerate(texts)]), weights).collect()
    found = wrong = 0
    for r in got:
        text, gone = texts[r.doc_id]
        assert [(s.start, P.KINDS.index(s.kind), s.end) for s in r.spans if s.base] == P.base_spans(text)
        want = {(k, t) for k, t in gone}
        named = {("secret", text[a:b]) for a, b, _ in P.named_secrets(text)}
        added = {(s.kind, text[s.start : s.end]) for s in r.spans if not s.base}
        found += len(added & want)
        wrong += len(added - want - named)
    total = sum(len({*gone}) for _, gone in texts)
    assert found >= 0.9 * total and found >= 0.9 * (found + wrong), (found, wrong, total)


def test_the_model_adds_spans_on_the_test_table(spark):
    sf = SF.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    named = {(d, a, b) for d, t in texts.items() for a, b, _ in P.named_secrets(t)}
    added = set()
    for r in P.op2_personal_data(spark, sf).collect():
        assert "secret" not in brute(texts[r.doc_id] or "") and r.n_card == sum(s[1] == 2 for s in brute(texts[r.doc_id]))
        for x in filter(None, r.spans.split(",")):
            kind, a, b = x.split(":")
            if kind == "secret":
                added.add((r.doc_id, int(a), int(b)))
    assert named and len(named & added) >= 0.9 * len(named) and len(added - named) <= 0.1 * len(added)
