"""The training corpus from raw documents: five stages, each reading what the
one before it wrote.

1. quality rules: documents that fail the rules or the classifier go;
2. line dedup: later occurrences of three-line windows are cut from the texts;
3. near-dedup: one document of each near-duplicate group stays;
4. decontamination: documents that hold a benchmark passage go;
5. mixing: documents are taken until every source's words come to its target.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, all but the last with the columns of documents. Clean documents
pass the filtering stages unchanged. Empty tables, nulls, repeated rows, extra
columns and very long texts are the operators' cases, stated there; a stage adds
none of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridelens.llm.decontamination import drop_contaminated
from ridelens.llm.line_dedup import drop_repeated_lines
from ridelens.llm.mixing import take_mix
from ridelens.llm.near_dup import one_per_group
from ridelens.llm.quality import keep_good
from ridelens.llm.runtime import settle, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass; null, blank and short texts go. Without labels the rules decide alone."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a text that loses its last word goes, one without lines stays."""
    return drop_repeated_lines(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group at 80 %; texts without words stand alone, rows without an id stay."""
    return one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; with an empty benchmark all of them."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken, with their size and the words taken; those that give no word go."""
    return take_mix(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The classifier, the groups and the fingerprints are beyond SQL; the stages
#: are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
