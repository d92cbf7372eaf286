"""The stages in order, each against the operator's own answer on its input,
and what the whole must catch or keep."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from llm_help import SF, words_of
from ridelens.llm import registry
from ridelens.llm.decontamination import contaminated
from ridelens.llm.line_dedup import cut_repeated_lines
from ridelens.llm.mixing import weighted_targets
from ridelens.llm.near_dup import near_duplicates
from ridelens.llm.quality import quality_rules
from ridelens.llm.runtime import settle, table

BIG = SF.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, BIG, "documents")]
    for name, stage in C.STAGES:
        docs.append(settle(stage(spark, docs[-1], BIG), name))
    return docs


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stages_are_the_five_in_order():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "near_dup", "decontamination", "mixing"]
    assert {f"op{n}" for n in range(1, 14)} == {q.partition("_")[0] for q in registry.QUERIES if q != "pipeline"}
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES) and registry.QUERIES["pipeline"] is C.run


def test_all_but_the_last_return_the_columns_of_documents(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality_stage_keeps_what_the_operator_keeps(spark, steps):
    kept = quality_rules(steps[0], table(spark, BIG, "labels")).where("kept").select("doc_id")
    assert rows(steps[1]) == rows(steps[0].join(kept, "doc_id", "left_semi").select(steps[0].columns))


def test_line_stage_cuts_what_the_operator_cuts(steps):
    cut = {r.doc_id: r for r in cut_repeated_lines(steps[1]).collect()}
    got = {r.doc_id: r for r in steps[2].collect()}
    for d, r in cut.items():
        if r.removed and not words_of(r.kept_text):
            assert d not in got
        else:
            assert got[d].text == r.kept_text
    changed = [d for d, r in got.items() if cut[d].removed]
    assert changed and all(got[d].n_chars == len(got[d].text) for d in changed)


def test_near_dup_stage_keeps_one_of_each_group(steps):
    found = near_duplicates(steps[2], 80, bands=36, rows=5)
    assert rows(steps[3].select("doc_id")) == rows(found.where("kept").select("doc_id"))
    assert rows(steps[3]) == rows(steps[2].join(found.where("kept"), "doc_id", "left_semi").select(steps[2].columns))


def test_decontamination_stage_drops_what_the_operator_finds(spark, steps):
    found = contaminated(steps[3], table(spark, BIG, "benchmark")).select("doc_id")
    assert found.count() and rows(steps[4]) == rows(steps[3].join(found, "doc_id", "left_anti").select(steps[3].columns))


def test_mixing_stage_meets_the_targets(steps):
    sizes = {}
    for r in steps[4].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(words_of(r.text))
    taken = {r.source: r.t for r in steps[5].groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert taken == {s: round(t) for s, t in weighted_targets(sizes).items()}
    assert steps[5].where("taken > 3 * size or taken <= 0").count() == 0


def test_run_gives_the_last_stage(spark, steps):
    assert rows(C.run(spark, BIG)) == rows(steps[5])
