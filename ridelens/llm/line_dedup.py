"""Repeated runs of three lines: consecutive lines are hashed together, equal
windows are found across all documents, and the lines of every later
occurrence go, overlapping windows merged.

The first occurrence by (doc_id, line) stays. A task settles the repeats within
a slice of its documents and asks only about the first occurrence in it. The
first of all is an aggregate, summed up partially in every task, and goes back
to those who asked by an equi-join, which Spark can split: no task holds all
rows of a window, whatever its share. The covered lines come back as one list
per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.runtime import carry, documents, fresh, settle, ship, table

LINES = 3


def _lines(text: bytes | None) -> tuple[list[bytes], list[int]]:
    """All \\n-split lines, and the numbers of those with a word."""
    lines = (text or b"").split(b"\n")
    return lines, [i for i, x in enumerate(lines) if x.strip()]


def _asked(docs: DataFrame, run_of: int) -> DataFrame:
    """(high, low, known, doc_id, place): a row per window; known: its slice
    holds an earlier occurrence."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in W.slices(batch, "text"):
                first: dict[bytes, tuple[int, int]] = {}
                rows: list[tuple[bytes, int, int]] = []
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                for doc, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    lines, full = _lines(text)
                    for place in range(len(full) - run_of + 1):
                        key = hashlib.blake2b(b"\n".join(lines[i] for i in full[place : place + run_of]), digest_size=16).digest()
                        rows.append((key, doc, place))
                        if key not in first or (doc, place) < first[key]:
                            first[key] = (doc, place)
                keys = np.frombuffer(b"".join(k for k, _, _ in rows), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[:, 0]),
                        pa.array(keys[:, 1]),
                        pa.array([first[k] != (d, p) for k, d, p in rows], pa.bool_()),
                        pa.array([d for _, d, _ in rows], pa.int64()),
                        pa.array([p for _, _, p in rows], pa.int32()),
                    ],
                    names=["high", "low", "known", "doc_id", "place"],
                )

    return docs.mapInArrow(run, "high bigint, low bigint, known boolean, doc_id bigint, place int")


def _marked(df: DataFrame, run_of: int) -> tuple[DataFrame, list[str]]:
    """``df`` with n_lines, removed, kept_text (columns lengthened where taken)."""
    ship(df.sparkSession)
    id_type = F.col("doc_id").cast("bigint")
    asked = settle(_asked(documents(df, "doc_id", "text").where("doc_id is not null"), run_of), "windows")
    open_rows = asked.where("not known").select("high", "low", "doc_id", "place")
    firsts = open_rows.groupBy("high", "low").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    beaten = open_rows.join(firsts, ["high", "low"]).where(F.struct("doc_id", "place") > F.col("first"))
    later = asked.where("known").select("doc_id", "place").unionByName(beaten.select("doc_id", "place"))
    at, places = fresh(df.columns, "place_of"), fresh(df.columns, "places")
    listed = later.groupBy(F.col("doc_id").alias(at)).agg(F.collect_set("place").alias(places))
    placed = df.where("doc_id is not null").join(listed, id_type == F.col(at), "left").drop(at)
    adrift = df.where("doc_id is null").withColumn(places, F.lit(None).cast("array<int>"))

    def run(batch: pa.RecordBatch):
        for part in W.slices(batch, "text"):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            n, gone, kept = [], [], []
            for text, found in zip(texts, part.column(places).to_pylist(), strict=True):
                lines, full = _lines(text)
                covered = {full[i] for p in found or () for i in range(p, p + run_of) if i < len(full)}
                n.append(len(full))
                gone.append(sorted(covered))
                kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in covered) if covered else text)
            yield part, [pa.array(n, pa.int64()), pa.array(gone, pa.list_(pa.int32())), pa.array(kept, pa.binary()).cast(pa.string())]

    out, names = carry(placed.unionByName(adrift), run, "n_lines bigint, removed array<int>, kept_text string")
    return out.drop(places), names


def cut_repeated_lines(df: DataFrame, run_of: int = LINES) -> DataFrame:
    """Removes, from (doc_id, text), the lines of every window of ``run_of``
    consecutive lines that occurs earlier, in the same document or in one with
    a smaller doc_id. Lines are split at \\n and compared byte for byte; lines
    without a word are passed over and stay.

    Returns doc_id, n_lines (with a word), removed (numbers of removed lines,
    from 0, among all lines), kept_text (null for null). Defined cases: texts
    with fewer lines than a window lose nothing; rows that repeat a doc_id tie
    at equal places, so neither copy loses lines to the other there, and all of
    a doc_id's rows lose the places found for it; rows with null doc_id lose
    nothing and take nothing from others; a very long text is cut whole, its
    task holds its lines; an empty table gives an empty result; other columns
    are ignored."""
    out, _ = _marked(documents(df, "doc_id", "text"), run_of)
    return out.drop("text")


def drop_repeated_lines(df: DataFrame, run_of: int = LINES) -> DataFrame:
    """The rows of ``df`` with such lines cut from text, and n_chars (if there)
    brought up to date; a document that loses its last word goes. Other cases
    as in ``cut_repeated_lines``."""
    out, (n_lines, removed, kept) = _marked(df, run_of)
    out = out.where((F.size(removed) == 0) | F.col(kept).rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col(kept), "n_chars": F.when(F.size(removed) == 0, F.col("n_chars")).otherwise(F.length(kept)) if "n_chars" in df.columns else None}
    return out.select(*[changed[c].alias(c) if changed.get(c) is not None else F.col(f"`{c}`") for c in df.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without lines that came before; cases as in ``cut_repeated_lines``."""
    out = cut_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH raw AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), line AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM raw
), full_line AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), win AS (
  SELECT a.doc_id, a.n, a.line || chr(10) || b.line || chr(10) || c.line AS w
  FROM full_line a JOIN full_line b ON b.doc_id = a.doc_id AND b.n = a.n + 1
  JOIN full_line c ON c.doc_id = a.doc_id AND c.n = a.n + 2
), later AS (
  SELECT doc_id, n FROM (SELECT doc_id, n, row_number() OVER (PARTITION BY w ORDER BY doc_id, n) AS k FROM win) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, n + k.k AS n FROM later, range(3) AS k(k)
), marked AS (
  SELECT line.doc_id, line.i, line.line, full_line.n IS NOT NULL AS has_word, gone.n IS NOT NULL AS removed
  FROM line LEFT JOIN full_line ON full_line.doc_id = line.doc_id AND full_line.i = line.i
  LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.n = full_line.n
)
SELECT doc_id, CAST(count(*) FILTER (has_word) AS BIGINT) AS n_lines, CAST(count(*) FILTER (removed) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT removed), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
