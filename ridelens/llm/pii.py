"""Personal data: fixed patterns, and a skip-chain conditional random field
that finds what they do not, and carries labels to similar tokens of the same
document.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Then
every token with a digit, an @ or an "(at)" is a node; all other tokens are
clamped to "no entity", which cuts the chain, so nothing is lost by leaving them
out. Nodes that are next to each other share a transition potential; nodes that
repeat or resemble each other, however far apart, share a skip potential that
favours one label. Each node is tied to the next one it resembles only, so a
token repeated thousands of times gives a line of potentials, not all pairs.
Loopy message passing gives each node's label probabilities; confident nodes
outside the patterns' spans become added spans.

The weights are fitted by pseudo-likelihood on a bounded sample (``TRAIN_ROWS``
documents with nodes, the smallest hashes of doc_id), with the patterns' labels
as the truth, and those of secrets (tokens behind a name like ``token =``, which
are no base kind and only ever added). A model that sees the patterns' own tests
(a plus sign, four parts, a checksum, a dot behind the @) learns nothing but
these. So every node is learned from three times: as it is; with the tests
hidden; and with its neighbours hidden too. What the shape of a token and the
words beside it say then has to carry the label, also where an entity is
damaged: no plus, a part too large, "(at)", a number spelled another way.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.runtime import documents, ship, table

#: Kinds of the patterns, and the one that is only added.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS, _SECRET = KINDS[:4], 4
TRAIN_ROWS = 3000
MIN_POSTERIOR = 0.9
#: What a tie of similar tokens adds for one label, before any is seen.
SKIP_PRIOR = 4.0
#: Messages of a text are passed until none changes by more.
TOLERANCE, DAMPING = 1e-8, 0.3
_OTHER = len(KINDS)  # label of tokens without an entity

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# A match starts at a token's start only and never gives characters back, so long tokens cost no more than their length.
_NODE = re.compile(r"(?<![^ \t-\r])(?:[^ \t-\r0-9@(\[]|[(\[](?!at[)\]]))*+[0-9@(\[][^ \t-\r]*")
_AT = re.compile(r"[(\[]at[)\]]")
# Names that secrets are written behind.
_NAMED = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)[\"']?[ \t]*[:=][ \t]*[\"']?([0-9A-Za-z_+/-]{16,})")
_CORE = re.compile(r"[0-9A-Za-z+(](?:.*[0-9A-Za-z)])?", re.S)

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: an address begins where its run of local characters
    does, or where the last address ended."""
    after, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > after and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            yield begin, m.end()
            after = m.end()
        at = text.find("@", m.end() if m else at + 1)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start, then kind."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass
class Graph:
    """Nodes of some texts. ``features``: numbers of features (0: none), a row per
    node; ``labels``: from the patterns; ``inside``: whether a base span covers
    the node; ``near``/``skip``: pairs of nodes (left, right)."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    features: np.ndarray
    labels: np.ndarray
    inside: np.ndarray
    near: np.ndarray
    skip: np.ndarray


_MARKS = "@.()-=:/#_\"%"
_SIZES = (1, 2, 4, 7, 10, 14, 20, 33)
#: Buckets of a token's shape, and of the word on either side.
_SHAPES, _WORDS = 64, 64


def _bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % size


def _shape(core: str) -> str:
    """Runs of digits by their length (all long ones alike), runs of letters as one."""
    out = _DIGITS.sub(lambda m: str(min(len(m[0]), 9)), core[:64])
    return _LETTERS.sub("a", out)


_DIGITS, _LETTERS = re.compile("[0-9]+"), re.compile(r"[^\W\d_]+")

#: Features have numbers: 0 is none; then come the bias, marks, sizes, letters,
#: marks around the core, the patterns' tests, shapes, words before and behind.
_BIAS = 1
_OF_MARK = _BIAS + 1
_OF_SIZE = _OF_MARK + len(_MARKS)
_ALPHA = _OF_SIZE + len(_SIZES)
_AROUND, _MIXED = _ALPHA + 1, _ALPHA + 2
_TESTS = _MIXED + 1
_OF_SHAPE = _TESTS + 4
_OF_LEFT = _OF_SHAPE + _SHAPES
_OF_RIGHT = _OF_LEFT + _WORDS
N_FEATURES = _OF_RIGHT + _WORDS
#: Places of a node's features: the tests are in those from _TEST_SLOT on, four of them.
_TEST_SLOT = 4 + len(_MARKS) + len(_SIZES)
_SLOTS = _TEST_SLOT + 4 + 3


def _describe(token: str, core: str, left: str, right: str) -> list[int]:
    """The numbers of a node's features, each in its place."""
    core = _AT.sub("@", core[:4096])
    digits = [c for c in core if c in "0123456789"]
    parts = core.split(".")
    alpha = any(c.isalpha() for c in core)
    tests = (
        core.startswith("+"),
        len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
        14 <= len(digits) <= 19 and luhn("".join(digits)),
        "@" in core[1:-1] and "." in core.rpartition("@")[2],
    )
    out = [_BIAS]
    out += [(_OF_MARK + i) * (m in (token if m == '"' else core)) for i, m in enumerate(_MARKS)]
    out += [(_OF_SIZE + i) * (len(digits) >= n) for i, n in enumerate(_SIZES)]
    out += [_ALPHA * alpha, _AROUND * (len(token) != len(core)), _MIXED * (alpha and len(digits) >= 4 and len(core) >= 16)]
    out += [(_TESTS + i) * bool(x) for i, x in enumerate(tests)]
    shape = _shape(core.lstrip("+"))
    return out + [_OF_SHAPE + _bucket(shape, _SHAPES), *[(of + _bucket(w, _WORDS)) * bool(w) for of, w in ((_OF_LEFT, left), (_OF_RIGHT, right))]]


_WORD_LEFT, _WORD_RIGHT = re.compile(r"([^ \t-\r]{1,32})[ \t-\r]{1,4}\Z"), re.compile(r"[ \t-\r]{1,4}([^ \t-\r]{1,32})")


def _beside(text: str, lo: int, hi: int) -> tuple[str, str]:
    """The words before and behind a token, lower-case and without marks around
    them; nodes say nothing here (the chain ties them)."""
    left, right = _WORD_LEFT.search(text, max(0, lo - 40), lo), _WORD_RIGHT.match(text, hi)
    return tuple("" if m is None or any(c in "0123456789@" for c in m[1]) else (m[1].lower().strip(".,;:()[]\"'") or m[1]) for m in (left, right))


def _keys(core: str) -> list[str]:
    """What similar tokens have in common: the same letters and digits, the
    same last six digits, or the same part before an @."""
    low = _AT.sub("@", core.lower())
    digits = "".join(c for c in low if c in "0123456789")
    out = ["t" + "".join(c for c in low if c.isalnum())]
    if len(digits) >= 6:
        out.append("d" + digits[-6:])
    head = low.partition("@")[0]
    if len(head) >= 5:
        out.append("h" + head)
    return out


def named_secrets(text: str) -> list[Span]:
    """Tokens behind a name that says they are secret, with a digit in them."""
    return [(*m.span(1), _SECRET) for m in _NAMED.finditer(text) if any(c.isdigit() for c in m[1])]


def read_graph(texts: list[tuple[int, str, list[Span]]]) -> Graph:
    """Of (text number, text, pattern spans)."""
    start, end, doc, features, labels, inside, near, skip = [], [], [], [], [], [], [], []
    for number, text, spans in texts:
        last: dict[str, int] = {}
        at_span, before = 0, None
        secrets = {a: b for a, b, _ in named_secrets(text)}
        for m in _NODE.finditer(text):
            core = _CORE.search(m[0])
            if not core or not (any(c in "0123456789@" for c in m[0]) or _AT.search(m[0])):
                continue
            node, (lo, hi) = len(start), (m.start() + core.start(), m.start() + core.end())
            while at_span < len(spans) and spans[at_span][2] <= lo:
                at_span += 1
            over = [s for s in spans[at_span : at_span + 8] if s[0] < hi and lo < s[2]]
            start.append(lo)
            end.append(hi)
            doc.append(number)
            features.append(_describe(m[0], core[0], *_beside(text, m.start(), m.end())))
            labels.append(over[0][1] if over else _SECRET if secrets.get(lo) == hi else _OTHER)
            inside.append(bool(over))
            if before is not None and text[before[1] : m.start()].isspace() and m.start() - before[1] == 1:
                near.append((before[0], node))
            before = (node, m.end())
            tied = set()
            for key in _keys(core[0]):
                if key in last and last[key] not in tied:
                    skip.append((last[key], node))
                    tied.add(last[key])
                last[key] = node
    return Graph(
        np.array(start, np.int64),
        np.array(end, np.int64),
        np.array(doc, np.int64),
        np.array(features, np.int16).reshape(-1, _SLOTS),
        np.array(labels, np.int64),
        np.array(inside, bool),
        np.array(near, np.int64).reshape(-1, 2),
        np.array(skip, np.int64).reshape(-1, 2),
    )


@dataclass
class Weights:
    unary: np.ndarray  # features x labels
    near: np.ndarray  # left label x right label
    skip: np.ndarray  # label x label, agreement on the diagonal


def _views(graph: Graph) -> tuple[np.ndarray, ...]:
    """What is learned from: features, labels, and the labels next to a node and
    tied to it (as counts); equal rows once, with their number. Three views of a
    node: as it is, without the patterns' tests, and without neighbours as well."""
    k = _OTHER + 1
    truth = np.eye(k, dtype=np.int16)[graph.labels]
    around = np.zeros((3, len(graph.labels), k), np.int16)
    np.add.at(around[0], graph.near[:, 1], truth[graph.near[:, 0]])
    np.add.at(around[1], graph.near[:, 0], truth[graph.near[:, 1]])
    for a, b in ((0, 1), (1, 0)):
        np.add.at(around[2], graph.skip[:, a], truth[graph.skip[:, b]])
    hidden = graph.features.copy()
    hidden[:, _TEST_SLOT : _TEST_SLOT + 4] = 0
    beside = np.concatenate(around, axis=1)
    rows = np.concatenate([np.column_stack((graph.labels.astype(np.int16), x, y)) for x, y in ((graph.features, beside), (hidden, beside), (hidden, 0 * beside))])
    rows, n = np.unique(rows, axis=0, return_counts=True)
    beside = rows[:, 1 + _SLOTS :].astype(np.float64)
    return rows[:, 1 : 1 + _SLOTS], rows[:, 0].astype(np.int64), beside[:, :k], beside[:, k : 2 * k], beside[:, 2 * k :], n.astype(np.float64)


def fit(graph: Graph, rounds: int = 400, rate: float = 0.5, decay: float = 2e-4) -> Weights | None:
    """Pseudo-likelihood: each node's label given its neighbours' labels, by
    gradient ascent. None unless some node has an entity and some has none."""
    k = _OTHER + 1
    if len(np.unique(graph.labels)) < 2 or not (graph.labels == _OTHER).any():
        return None
    numbers, labels, from_left, from_right, tied, times = _views(graph)
    features = np.zeros((len(numbers), N_FEATURES))
    features[np.arange(len(numbers))[:, None], numbers] = 1.0
    features[:, 0] = 0.0
    truth, n = np.eye(k)[labels], times.sum()
    # Few samples hold an entity twice; until they say otherwise, resemblance speaks for one label.
    prior = (0.0, 0.0, np.eye(k) * SKIP_PRIOR)
    w = Weights(np.zeros((N_FEATURES, k)), np.zeros((k, k)), prior[2].copy())
    seen = [np.full(x.shape, 1e-6) for x in (w.unary, w.near, w.skip)]
    for _ in range(rounds):
        logits = features @ w.unary + from_left @ w.near + from_right @ w.near.T + tied @ w.skip
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        err = (truth - p / p.sum(axis=1, keepdims=True)) * times[:, None]
        agree = np.diag((tied * err).sum(axis=0))
        grads = (features.T @ err, from_left.T @ err + err.T @ from_right, agree)
        for x, g, s, usual in zip((w.unary, w.near, w.skip), grads, seen, prior, strict=True):
            g = g / n - decay * (x - usual)
            s += g**2
            x += rate * g / np.sqrt(s)
    np.fill_diagonal(w.skip, np.maximum(np.diag(w.skip), 0))  # resemblance never speaks for different labels
    return w


def _unary(graph: Graph, w: Weights) -> np.ndarray:
    """Sums of the weights of each node's features."""
    out = np.zeros((len(graph.features), w.unary.shape[1]))
    for low in range(0, len(out), 1 << 14):
        out[low : low + (1 << 14)] = w.unary[graph.features[low : low + (1 << 14)]].sum(axis=1)
    return out


def posteriors(graph: Graph, w: Weights, iterations: int | None = None) -> np.ndarray:
    """Label probabilities of every node by damped sum-product message passing.
    A text's messages are passed until they stand still: evidence goes a link a
    round, so a long line takes as many rounds as it has links. Loops may never
    settle, so twice a text's nodes (and some rounds for damping), or
    ``iterations``, are the most."""
    unary = _unary(graph, w)
    pairs = np.concatenate((graph.near, graph.skip))
    if len(pairs):
        tables = np.concatenate((np.broadcast_to(w.near, (len(graph.near), *w.near.shape)), np.broadcast_to(w.skip, (len(graph.skip), *w.skip.shape))))
        to = np.concatenate((pairs[:, 1], pairs[:, 0]))
        source = np.concatenate((pairs[:, 0], pairs[:, 1]))
        potential = np.concatenate((tables, tables.transpose(0, 2, 1)))  # source label x target label
        back = np.concatenate((np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))))
        sent = np.zeros((len(to), unary.shape[1]))
        _, text = np.unique(graph.doc, return_inverse=True)
        most = 100 + 2 * np.bincount(text) if iterations is None else np.full(text.max() + 1, iterations)
        live, done = np.arange(len(to)), 0  # messages of the texts that still change
        while len(live := live[most[text[to[live]]] > done]):
            nodes, at = np.unique(to[live], return_inverse=True)
            belief = unary[nodes]
            np.add.at(belief, at, sent[live])
            # Every live message's source is the target of the one back, so it is a live node too.
            out = (belief[np.searchsorted(nodes, source[live])] - sent[back[live]])[:, :, None] + potential[live]
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            new = DAMPING * sent[live] + (1 - DAMPING) * new
            change = np.zeros(len(most))
            np.maximum.at(change, text[to[live]], np.abs(new - sent[live]).max(axis=1))
            sent[live] = new
            live = live[change[text[to[live]]] > TOLERANCE]
            done += 1
        np.add.at(unary, to, sent)
    unary = unary - unary.max(axis=1, keepdims=True)
    p = np.exp(unary)
    return p / p.sum(axis=1, keepdims=True)


def added_spans(graph: Graph, w: Weights) -> Iterator[tuple[int, Span]]:
    """(text number, span) of confident nodes that no pattern covers; neighbours of one kind join."""
    if not len(graph.labels):
        return
    p = posteriors(graph, w)
    kind = p.argmax(axis=1)
    sure = (kind != _OTHER) & (p.max(axis=1) >= MIN_POSTERIOR) & ~graph.inside
    next_to = set(map(tuple, graph.near.tolist()))
    run: list[int] = []
    for i in [*np.flatnonzero(sure).tolist(), None]:
        if run and (i is None or (run[-1], i) not in next_to or kind[i] != kind[run[0]]):
            yield int(graph.doc[run[0]]), (int(graph.start[run[0]]), int(kind[run[0]]), int(graph.end[run[-1]]))
            run = []
        if i is not None:
            run.append(i)


def _with_marks(part: pa.RecordBatch) -> list[tuple[int, str]]:
    """(row, text) of the texts with a digit, an @ or what may be an "(at)"."""
    data, offsets = W.text_buffer(part.column("text"))
    marked = ((data >= 48) & (data <= 57)) | (data == 64)
    marked[:-3] |= ((data[:-3] == 40) | (data[:-3] == 91)) & (data[1:-2] == 97) & (data[2:-1] == 116)
    total = np.concatenate(([0], np.cumsum(marked)))
    rows = np.flatnonzero(total[offsets[1:]] > total[offsets[:-1]])
    texts = part.column("text").take(pa.array(rows)).to_pylist()
    return list(zip(rows.tolist(), texts, strict=True))


def train(df: DataFrame, rows: int = TRAIN_ROWS) -> Weights | None:
    """Fits on the pattern labels of at most ``rows`` documents (doc_id, text)
    that hold a digit or an @ (of rows that repeat a doc_id any may count)."""
    ship(df.sparkSession)
    docs = documents(df, "doc_id", "text").where(F.col("text").rlike(r"[0-9@]"))
    chosen = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        """A text's nodes and the words beside them: all that training reads."""
        for batch in batches:
            texts = ["\n".join(_node_lines(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "nodes"])

    found = sample.mapInArrow(run, "doc_id bigint, nodes string").toArrow().sort_by("doc_id")
    texts = found["nodes"].to_pylist()
    return fit(read_graph([(i, t, base_spans(t)) for i, t in enumerate(texts)])) if texts else None


def _node_lines(text: str) -> list[str]:
    """Runs of adjacent nodes of a text with what is before and behind, a line each."""
    out, ends = [], []
    for m in _NODE.finditer(text):
        if out and m.start() == ends[-1] + 1 and text[ends[-1]] == " ":
            out[-1], ends[-1] = (out[-1][0], m.end()), m.end()
        else:
            out.append((m.start(), m.end()))
            ends.append(m.end())
    lines = []
    for lo, hi in out:
        left, right = re.search(r"[^\r\n]{0,40}\Z", text[max(0, lo - 40) : lo]), re.match(r"[^\r\n]{0,40}", text[hi : hi + 40])
        # Pieces of other nodes beside these would be taken for nodes.
        lines.append(re.sub(r"\S*[0-9@(\[]\S*", " ", left[0]) + text[lo:hi] + re.sub(r"\S*[0-9@(\[]\S*", " ", right[0]))
    return lines


def find_personal_data(df: DataFrame, weights: Weights | None) -> DataFrame:
    """For every row of (doc_id, text): doc_id, spans (start and end in code
    points, end exclusive, kind, base: whether a pattern found it), by start,
    then kind (``secret`` is never base). Defined cases: a null or empty text has no spans; without weights
    (no entity to learn from) the patterns stand alone; rows that repeat a
    doc_id, or have none, are read on their own; a very long text is read whole,
    its task holds its nodes; an empty table gives an empty result; other
    columns are ignored."""
    ship(df.sparkSession)
    docs = documents(df, "doc_id", "text")
    shared = df.sparkSession.sparkContext.broadcast(weights)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]):
        known = shared.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                spans: list[list[tuple[int, int, int, bool]]] = [[] for _ in range(part.num_rows)]
                texts = [(row, text, base_spans(text)) for row, text in _with_marks(part)]
                for row, _, found in texts:
                    spans[row] = [(*s, True) for s in found]
                if known:
                    for row, s in added_spans(read_graph(texts), known):
                        spans[row].append((*s, False))
                rows = [[{"start": a, "end": b, "kind": KINDS[k], "base": base} for a, k, b, base in sorted(x)] for x in spans]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, span)], names=["doc_id", "spans"])

    return docs.mapInArrow(run, "doc_id bigint, spans array<struct<start:int,end:int,kind:string,base:boolean>>")


def op2_personal_data(spark, sf_dir: str) -> DataFrame:
    """Spans of all documents; cases as in ``find_personal_data``."""
    docs = table(spark, sf_dir, "documents")
    found = find_personal_data(docs, train(docs))
    base = F.filter("spans", lambda s: s["base"])

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))
