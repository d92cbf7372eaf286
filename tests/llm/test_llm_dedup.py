"""Substring and line dedup: DuckDB on the test tables, plain Python on edges."""

from __future__ import annotations

import pytest

from llm_help import SF, docs_frame, duck_rows, spark_rows, words_of
from ridelens.llm.line_dedup import OP4_SQL, cut_repeated_lines, drop_repeated_lines, op4_line_dedup
from ridelens.llm.substring_dedup import OP3_SQL, cut_repeated_windows, levels, op3_substring_dedup


def test_substring_dedup_matches_sql(spark):
    assert spark_rows(op3_substring_dedup(spark, SF)) == duck_rows(OP3_SQL)


def test_line_dedup_matches_sql(spark):
    assert spark_rows(op4_line_dedup(spark, SF)) == duck_rows(OP4_SQL)


def brute_windows(rows, window):
    first = {}
    for doc, text in rows:
        w = words_of(text)
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words_of(text)
        gone = {j for i in range(len(w) - window + 1) if doc is not None and first[tuple(w[i : i + window])] < doc for j in range(i, i + window)}
        out.append((doc, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


PASSAGE = " ".join(f"p{i}" for i in range(20))
EDGES = [
    (5, f"a b {PASSAGE} c"),
    (3, f"x {PASSAGE}"),
    (3, f"x {PASSAGE}"),  # repeated row
    (9, f"{PASSAGE} {PASSAGE}"),
    (7, None),
    (8, ""),
    (None, f"{PASSAGE} tail"),  # no place in the order
    (10, " ".join(["t"] * 40)),  # one word, repeated inside its own document only
    (11, "short text"),
    (12, f"q {' '.join(f'p{i}' for i in range(5, 18))} r"),
]


@pytest.mark.parametrize("window", [3, 7, 8, 13, 20])
def test_windows_on_edges_match_brute_force(spark, window):
    got = cut_repeated_windows(docs_frame(spark, EDGES, extra=True), window)
    rows = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str)
    assert rows == brute_windows(EDGES, window)
    for r in got.collect():
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_levels_at_most_double():
    for window in range(1, 200):
        ladder = levels(window)
        assert ladder[-1] == window and all(a < b <= 2 * a for a, b in zip(ladder, ladder[1:], strict=False))


def test_windows_found_over_more_levels(spark):
    long = " ".join(f"w{i}" for i in range(70))
    rows = [(1, long), (2, f"a {long} b"), (3, " ".join(f"w{i}" for i in range(49)))]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in cut_repeated_windows(docs_frame(spark, rows), 50).collect()), key=str)
    assert got == brute_windows(rows, 50)


def test_the_texts_are_shuffled_once(spark):
    from conftest import plan_text

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        plan = plan_text(cut_repeated_windows(spark.read.parquet(f"{SF}/documents.parquet")))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("ReusedExchange") >= 1
    exchanged = [x for x in plan.split("\n\n") if "Exchange" in x.split("\n")[0] and "text#" in x and "Reused" not in x]
    assert len(exchanged) == 1


def test_empty_tables_give_empty_results(spark):
    empty = docs_frame(spark, [])
    assert cut_repeated_windows(empty).count() == 0
    assert cut_repeated_lines(empty).count() == 0
    assert drop_repeated_lines(empty).count() == 0


LINES = [
    (4, "a\nb\nc\nd"),
    (2, "a\nb\nc"),
    (2, "a\nb\nc"),  # repeated row: a tie
    (6, "x\n\na\n \nb\nc\n"),  # blank lines are passed over and stay
    (7, None),
    (8, ""),
    (None, "a\nb\nc"),
    (9, "l\nl\nl\nl\nl"),  # repeats itself: the first window stays
    (10, "a\nb"),
]


def test_lines_on_edges(spark):
    got = {}
    for r in cut_repeated_lines(docs_frame(spark, LINES, extra=True)).collect():
        got.setdefault(r.doc_id, []).append((r.n_lines, r.removed, r.kept_text))
    assert got[2] == [(3, [], "a\nb\nc")] * 2
    assert got[4] == [(4, [0, 1, 2], "d")]
    assert got[6] == [(4, [2, 4, 5], "x\n\n \n")]
    assert got[7] == [(0, [], None)] and got[8] == [(0, [], "")]
    assert got[None] == [(3, [], "a\nb\nc")]
    assert got[9] == [(5, [1, 2, 3, 4], "l")]
    assert got[10] == [(2, [], "a\nb")]


def test_dropping_lines_keeps_columns_and_drops_emptied_documents(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", 5, "k"), (2, "a\nb\nc", 5, "k"), (3, "z\na\nb\nc", 7, None), (4, None, None, "k")], "doc_id int, text string, n_chars int, kept_text string")
    out = drop_repeated_lines(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a\nb\nc", 5, "k"), (3, "z", 1, None), (4, None, None, "k")]


def test_no_task_holds_all_rows_of_a_window(spark, monkeypatch):
    """One window in every slice: its rows are joined, never gathered by window."""
    from ridelens.llm import line_dedup as L
    from ridelens.llm import words as W

    monkeypatch.setattr(W, "SLICE_BYTES", 1)
    rows = [(i, f"own {i}\nhot one\nhot two\nhot three") for i in range(400)]
    df = docs_frame(spark, rows).repartition(8)
    plan = cut_repeated_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
    got = {r.doc_id: r.removed for r in cut_repeated_lines(df).collect()}
    assert got == {i: [1, 2, 3] if i else [] for i in range(400)}
    assert L.LINES == 3


def test_very_long_texts_among_short_ones(spark, monkeypatch):
    from ridelens.llm import substring_dedup as S

    monkeypatch.setattr(S, "HELD_WINDOWS", 50)
    long = " ".join(f"w{i}" for i in range(700_000))
    rows = [(1, PASSAGE), (2, f"{long} {PASSAGE}"), (3, long + " end"), (4, f"x {PASSAGE}")]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in cut_repeated_windows(docs_frame(spark, rows)).collect()}
    assert got == {1: (20, 0), 2: (700_020, 20), 3: (700_001, 700_000), 4: (21, 20)}
    lines = "\n".join(f"line {i}" for i in range(300_000))
    found = {r.doc_id: (r.n_lines, len(r.removed)) for r in cut_repeated_lines(docs_frame(spark, [(1, lines), (2, "first\n" + lines), (3, "a\nb")])).collect()}
    assert found == {1: (300_000, 0), 2: (300_001, 300_000), 3: (2, 0)}
