"""Targets, flow and selection: brute force and properties."""

from __future__ import annotations

import itertools
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_help import SF, docs_frame, words_of
from ridelens.llm import mixing as M


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 1000), min_size=1, max_size=8))
def test_targets_share_all_words_under_the_limit(sizes):
    targets = M.weighted_targets(sizes)
    total = sum(sizes.values())
    assert abs(sum(targets.values()) - total) < 1e-6 * max(1, total)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    per_weight = {s: targets[s] / M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    free = [s for s in order if targets[s] < 3 * sizes[s] - 1e-9]
    assert all(targets[s] <= 3 * sizes[s] + 1e-9 for s in order)
    for s in free:  # those below the limit share by weight; those at it would get no less
        assert all(per_weight[x] <= per_weight[s] + 1e-6 for x in order)


def test_null_source_comes_last():
    assert M.weighted_targets({None: 100, "b": 100, "a": 100}) == {"a": 187.5, "b": 75.0, None: 37.5}


def least_cost(patterns, quotas, most):
    """All integer flows by enumeration: the largest value, then the least cost."""
    arcs = [(p, s) for p, (own, _) in enumerate(patterns) for s in own if s in quotas]
    best = (0, 0)
    for amounts in itertools.product(*[range(quotas[s] + 1) for _, s in arcs]):
        given_by = [sum(a for a, (p, _) in zip(amounts, arcs, strict=True) if p == q) for q in range(len(patterns))]
        to = {s: sum(a for a, (_, x) in zip(amounts, arcs, strict=True) if x == s) for s in quotas}
        if all(to[s] <= quotas[s] for s in quotas) and all(g <= most * size for g, (_, size) in zip(given_by, patterns, strict=True)):
            best = max(best, (sum(amounts), -sum(cost(g, size) for g, (_, size) in zip(given_by, patterns, strict=True))))
    return best[0], -best[1]


def cost(amount, size):
    return sum(min(size, max(0, amount - k * size)) * k for k in range(1, 4))


def test_flow_is_largest_and_cheapest():
    rng = random.Random(8)
    for _ in range(25):
        names = ["a", "b", None]
        patterns = [(tuple(rng.sample(names, rng.randrange(1, 3))), rng.randrange(0, 3)) for _ in range(2)]
        quotas = {s: rng.randrange(0, 4) for s in names}
        found = M.route(patterns, quotas, 3)
        assert all(0 <= g <= 3 * size for g, (_, size) in zip(found, patterns, strict=True))
        assert (sum(found), sum(cost(g, size) for g, (_, size) in zip(found, patterns, strict=True))) == least_cost(patterns, quotas, 3)


def plain_flow(patterns, quotas, most):
    """Largest flow of least cost by Bellman-Ford, one shortest path at a time."""
    sources = list(quotas)
    start, end = "start", "end"
    room, price = {}, {}

    def arc(a, b, r, c):
        room[a, b], room[b, a], price[a, b], price[b, a] = r, 0, c, -c

    for p, (own, size) in enumerate(patterns):
        for k in range(most):
            arc(start, (p, k), size, k)
            arc((p, k), p, size, 0)
        for s in set(own) & set(sources):
            arc(p, ("to", s), 10**9, 0)
    for s in sources:
        arc(("to", s), end, quotas[s], 0)
    value = total = 0
    while True:
        away, came = {start: 0}, {}
        for _ in range(len(room)):
            changed = False
            for (a, b), r in room.items():
                if r > 0 and a in away and away[a] + price[a, b] < away.get(b, 10**9):
                    away[b], came[b], changed = away[a] + price[a, b], a, True
            if not changed:
                break
        if end not in away:
            return value, total
        path = [end]
        while path[-1] != start:
            path.append(came[path[-1]])
        steps = list(zip(path[1:], path, strict=False))
        amount = min(room[x] for x in steps)
        for a, b in steps:
            room[a, b] -= amount
            room[b, a] += amount
        value, total = value + amount, total + amount * away[end]


def test_flow_equals_a_plain_solver_on_overlapping_sources():
    rng = random.Random(3)
    for _ in range(40):
        names = [f"s{i}" for i in range(rng.randrange(2, 6))]
        patterns = [(tuple(rng.sample(names, rng.randrange(1, len(names) + 1))), rng.randrange(0, 20)) for _ in range(rng.randrange(1, 9))]
        quotas = {s: rng.randrange(0, 60) for s in names}
        found = M.route(patterns, quotas, 3)
        assert (sum(found), sum(cost(g, size) for g, (_, size) in zip(found, patterns, strict=True))) == plain_flow(patterns, quotas, 3)


def test_many_overlapping_patterns_take_less_than_a_minute():
    rng = random.Random(6)
    names = [f"s{i}" for i in range(50)]
    patterns = [(tuple(rng.sample(names, rng.randrange(1, 6))), rng.randrange(1, 10**6)) for _ in range(100_000)]
    total = sum(size for _, size in patterns)
    weights = [rng.random() ** 3 for _ in names]
    quotas = {s: round(1.1 * total * w / sum(weights)) for s, w in zip(names, weights, strict=True)}
    began = time.process_time()
    found = M.route(patterns, quotas, 3)
    assert time.process_time() - began < 60
    assert all(0 <= g <= 3 * size for g, (_, size) in zip(found, patterns, strict=True))
    drawn = min(3 * sum(size for own, size in patterns if names[0] in own), quotas[names[0]])
    assert sum(found) <= sum(quotas.values()) and sum(found) >= drawn


def test_words_can_be_taken_back_for_another_source():
    # The shared pattern must serve b: a has a pattern of its own.
    assert M.route([(("a", "b"), 10), (("a",), 10)], {"a": 10, "b": 10}, 1) == [10, 10]


def shared(sizes):
    """Targets by repeated water filling, written from the contract alone."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weigh = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and free:
        step = min(left / sum(weigh[s] for s in free), min((3 * sizes[s] - target[s]) / weigh[s] for s in free))
        for s in free:
            target[s] += step * weigh[s]
        left -= step * sum(weigh[s] for s in free)
        free = {s for s in free if target[s] < 3 * sizes[s] - 1e-9}
    return target


def test_documents_are_taken_by_hash_up_to_the_cut(spark, monkeypatch):
    for bits in (12, 2, 62):
        monkeypatch.setattr(M, "CELL_BITS", bits)
        rows = [(i % 150, f"s{i % 3}", 1 + i % 9) for i in range(400)] + [(7, "s1", 50)] * 30
        df = spark.createDataFrame(rows, "doc_id bigint, source string, n int")
        out, targets, _ = M.mix(df, F.col("n"), F.array("source"), lambda sizes: {s: n * 0.6 for s, n in sizes.items()})
        order = F.xxhash64(F.lit(M.SEED), F.col("doc_id")).bitwiseAND(F.lit((1 << M.ORDER_BITS) - 1))
        taken = {}
        for r in out.withColumn("o", order).collect():
            taken.setdefault(r.source, []).append((r.o, r.mix_size, r.mix_taken))
        for s, found in taken.items():
            assert sum(t for *_, t in found) == round(targets[s])
            cut = max(o for o, _, t in found if t)
            assert all(t == size for o, size, t in found if o < cut) and all(t == 0 for o, _, t in found if o > cut)
            assert sum(0 < t < size for o, size, t in found if o == cut) <= 1


def test_whole_table(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = M.op6_mixing(spark, SF).collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        d = docs[r.doc_id]
        assert r.size == len(words_of(d.text)) and 0 <= r.taken <= 3 * r.size
        sizes[d.source] = sizes.get(d.source, 0) + r.size
        taken[d.source] = taken.get(d.source, 0) + r.taken
        target[d.source] = r.target
    assert len(rows) == len(docs)
    want = shared(sizes)
    assert target.keys() == want.keys() and all(abs(target[s] - want[s]) < 1e-6 * sum(sizes.values()) for s in want)
    assert all(r.source_size == sizes[docs[r.doc_id].source] for r in rows)
    assert all(taken[s] == round(target[s]) for s in sizes)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.op6_mixing(spark, SF).collect()))


def test_overlapping_sources_and_edges(spark):
    rows = [(1, ["a", "b"], 10), (2, ["a"], 10), (3, [], 5), (4, None, 5), (5, [None], 7), (6, ["a", "b"], 0), (6, ["b", "a", "a"], 4), (None, ["b"], 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, own array<string>, n int").withColumn("mix_taken", F.lit("taken name"))
    out, targets, sizes = M.mix(df, F.col("n"), F.col("own"), lambda sizes: {"a": 20.0, "b": 10.0, None: 30.0})
    assert sizes == {"a": 24, "b": 17, None: 7} and targets["a"] == 20.0
    got = [(r.doc_id, r.mix_size, r.mix_taken_) for r in out.collect()]
    assert len(got) == len(rows)
    by_id = dict((d, t) for d, _, t in got if d != 6)
    assert by_id[3] == by_id[4] == 0 and by_id[5] == 21  # three passes are the most
    assert sum(t for d, _, t in got if d in (1, 2, 6, None)) == 30


def test_take_mix_of_an_empty_table_and_of_blank_texts(spark):
    df = docs_frame(spark, [(1, None), (2, " ")], extra=True).withColumn("source", F.lit("s"))
    assert M.take_mix(df).count() == 0 and M.take_mix(df.limit(0)).count() == 0
    out = M.take_mix(docs_frame(spark, [(1, "a b c"), (2, "d")], extra=True).withColumn("source", F.col("doc_id")))
    assert out.columns[-2:] == ["size_", "taken_"] and out.agg(F.sum("taken_")).first()[0] == 4


def test_a_source_may_hold_nearly_all(spark):
    rows = [(i, "big" if i % 10 else "small", "w " * (1 + i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    out, targets, _ = M.mix(df, M.word_count(), F.array("source"))
    taken = {r.source: r.t for r in out.groupBy("source").agg(F.sum("mix_taken").alias("t")).collect()}
    assert taken == {s: round(t) for s, t in targets.items()}
