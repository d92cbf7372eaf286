"""Shared by the tests of this folder."""

from __future__ import annotations

import re

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "benchmark")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def docs_frame(spark, rows, extra=False):
    """(doc_id, text) rows; ``extra`` adds columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    if extra:
        for name in ("kept", "n_words", "hashes", "places", "removed", "low", "component_id", "size", "taken", "mix_size", "contaminated", "score"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


def duck_rows(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.sql(sql)
    order = sorted(range(len(res.columns)), key=lambda i: res.columns[i])
    return sorted(res.columns), sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=str)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
