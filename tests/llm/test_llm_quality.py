"""Counts against plain Python, the classifier against held-out labels."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from llm_help import SF, docs_frame, words_of
from ridelens.llm import quality as Q

TEXTS = ["a b c a b c d", None, "", " \n\t", "x\nx\n \nx\ny", "# $ <a> | é&é", "one", "r " * 120, "ü" * 300, "a b c\na b c"]


def brute(text):
    w = words_of(text)
    threes = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if threes[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_counts_match_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(None, "a b c a b c")] * 2
    judged, names = Q.judge(docs_frame(spark, rows, extra=True), None)
    assert names[0] == "n_words_" and names[-1] == "kept_"  # taken names are lengthened
    got = sorted((tuple(r[n] for n in names[:6]) for r in judged.collect()))
    assert got == sorted(brute(t) for _, t in rows)
    assert all(r[names[-2]] is None and r[names[-1]] == (not r[names[-3]]) for r in judged.collect())


def synthetic(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        good = rng.random() < 0.7
        words = [f"{rng.choice('abcdef')}{rng.choice('aeiou')}{rng.randrange(40)}" for _ in range(80)]
        rows.append((i, " ".join(words if good else [w.upper() + "!!" if rng.random() < 0.5 else w for w in words]), int(good)))
    return rows


def test_the_classifier_separates_held_out_rows(spark):
    rows = synthetic(600, 1)
    df = docs_frame(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 2], "doc_id int, quality int")
    got = {r.doc_id: r for r in Q.quality_rules(df, labels).collect()}
    held = [(got[i].kept, bool(q)) for i, _, q in rows if i % 2 == 0]
    assert np.mean([a == b for a, b in held]) > 0.98
    p = [(got[i].p_quality, q) for i, _, q in rows if i % 2 == 0]
    assert np.mean([(x - q) ** 2 for x, q in p]) < 0.05  # calibrated: a small Brier score


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(None, 1), (1, None), (2, 7)]])
def test_without_two_kinds_of_labels_the_rules_decide(spark, labels):
    df = docs_frame(spark, [(1, "w " * 10), (2, " ".join(map(str, range(60))))])
    out = Q.quality_rules(df, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert {r.doc_id: (r.p_quality, r.kept) for r in out.collect()} == {1: (None, False), 2: (None, True)}


def test_keep_good_leaves_rows_as_they_were(spark):
    df = docs_frame(spark, [(1, " ".join(map(str, range(60)))), (2, None), (3, "few")], extra=True)
    out = Q.keep_good(df, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [tuple(df.first())]
    assert Q.keep_good(df.limit(0), spark.createDataFrame([], "doc_id bigint, quality int")).count() == 0


def test_sample_is_bounded_and_reruns_agree(spark):
    rows = synthetic(100, 2)
    df = docs_frame(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id bigint, quality int")
    a, b = (Q.train(df, labels, rows=60) for _ in range(2))
    assert (a[0] == b[0]).all() and a[1:] == b[1:]


def test_platt_recovers_a_known_curve():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=20000) * 2
    labels = (rng.random(20000) < 1 / (1 + np.exp(-(1.5 * scores - 0.7)))).astype(float)
    slope, shift = Q._platt(scores, labels)
    assert abs(slope - 1.5) < 0.1 and abs(shift + 0.7) < 0.1


def test_one_text_beyond_a_slice(spark):
    text = "word " * 600_000  # longer than a slice
    judged, _ = Q.judge(docs_frame(spark, [(1, text), (2, "a")]), None)
    got = {r.doc_id: (r.n_words, r.n_repeat_words) for r in judged.collect()}
    assert got == {1: (600_000, 600_000), 2: (1, 0)}
    assert pa.array([text]).nbytes > 2 << 20


def test_the_query_s_counts_match_brute_force_on_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op10_quality_rules(spark, SF).collect()
    assert {r.doc_id: tuple(r[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in rows} == {d: brute(t) for d, t in docs.items()}
    assert len(rows) == len(docs) and all(r.kept == (not r.base_failed and r.p_quality >= Q.MIN_PROBABILITY) for r in rows)
    # The verdict is learned from labels; on labelled rows it agrees with most of them.
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    agree = [(r.p_quality >= Q.MIN_PROBABILITY) == bool(labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert np.mean(agree) > 0.8
