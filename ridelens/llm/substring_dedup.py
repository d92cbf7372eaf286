"""Repeated word windows across documents, found by level-wise doubling.

A window of words can only repeat if every window inside it does. So short
windows are looked at first, and only those that repeat are extended to twice
their length (less at the last level, which is the asked length exactly): 13
words come from 7, 50 from 25 from 13 from 7. A level without survivors leaves
nothing to extend. Of the shortest windows only one in each window of the next
level is compared, the one with the smallest hash: equal windows pick equal
ones, so none is lost, and a quarter of them remain.

A level is one shuffle. Of ``HELD_WINDOWS`` windows at a time a task first settles
what it can: of the documents that share a window, only the one with the
smallest doc_id has to ask about it globally. A passage in a third of all
documents is thus a row per some megabytes of text in the shuffle, not one per
document.
The answers go back as one list of hashes per document.

Hashes have 64 bits: among n compared windows some pair of different ones is
taken for equal with probability n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.runtime import documents, settle, ship, table

WINDOW = 13
#: Windows that a task settles among themselves before it asks about the rest.
HELD_WINDOWS = 1 << 21


def levels(window: int) -> list[int]:
    """Window lengths, shortest first; each at most twice the one before."""
    out = [window]
    while out[0] > 7:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _picked(hashes: np.ndarray, doc: np.ndarray, window: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each full window: the smallest hash of its base windows, its first
    word's index, and its text's index."""
    rolled, _ = W.window_hashes(hashes, doc, base)
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    span = window - base + 1  # base windows in a full one
    low, width = rolled, 1
    while 2 * width <= span:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    rest = span - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    whole = np.flatnonzero(doc[:n] == doc[window - 1 :])
    return low[whole], whole, doc[whole]


def _values(column: pa.Array) -> np.ndarray:
    """All values of a list column as unsigned hashes."""
    return np.asarray(column.flatten()).astype(np.int64).view(np.uint64)


def _asked(hashes: np.ndarray, docs: np.ndarray, order_matters: bool) -> pa.RecordBatch:
    """Rows (hash, known, doc_id) of one batch. known 0: to be compared with other
    batches, one row per hash. Else the batch itself shows that the document
    shares the window (``order_matters``: with a smaller doc_id)."""
    order = np.lexsort((docs, hashes))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[new], docs[new]
    starts = W.group_starts(hashes)
    first = np.zeros(len(hashes), bool)
    first[starts] = True
    if order_matters:
        settled = np.flatnonzero(~first)
    else:
        settled = np.flatnonzero(np.repeat(np.diff(np.append(starts, len(hashes))) > 1, np.diff(np.append(starts, len(hashes)))))
    rows = np.concatenate((starts, settled))
    known = np.zeros(len(rows), np.int64)
    known[len(starts) :] = (docs[settled] & np.int64(0xFFFF)) + 1
    return pa.RecordBatch.from_arrays([pa.array(W.signed(hashes[rows])), pa.array(known), pa.array(docs[rows])], names=["hash", "known", "doc_id"])


def _windows(docs: DataFrame, length: int, shorter: int | None, sampled: bool, order_matters: bool) -> DataFrame:
    """The windows of ``length`` words to be compared, as rows of ``_asked``.

    With ``shorter``, only windows around survivors of that length (column
    hashes): of the sampled one inside, or of both halves. Without it, all
    windows; ``sampled`` then keeps the one with the smallest hash in each
    window of twice the length less one."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found, owners, held = [], [], 0
            ids = np.asarray(batch.column("doc_id")).astype(np.int64)
            at = 0
            for part in W.slices(batch, "text"):
                w = W.cut_words(part.column("text"))
                hashes = w.hashes()
                rolled, whole = W.window_hashes(hashes, w.doc, length)
                if shorter is None and sampled:
                    low, _, owner = _picked(hashes, w.doc, 2 * length - 1, length)
                    new = np.ones(len(low), bool)
                    new[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
                    found.append(low[new])
                    owners.append(ids[at + owner[new]])
                elif shorter is None:
                    found.append(rolled[whole])
                    owners.append(ids[at + w.doc[: len(rolled)][whole]])
                else:
                    kept = _values(part.column("hashes"))
                    if sampled:
                        low, place, _ = _picked(hashes, w.doc, 2 * shorter - 1, shorter)
                        alive = np.zeros(len(hashes), bool)
                        alive[place] = np.isin(low, kept)
                        # A window of the next level holds one or more sampled windows; any may be asked.
                        live = whole & alive[: len(rolled)]
                    else:
                        short, _ = W.window_hashes(hashes, w.doc, shorter)
                        alive = np.isin(short, kept)
                        live = whole & alive[: len(rolled)] & alive[length - shorter :][: len(rolled)]
                    found.append(rolled[live])
                    owners.append(ids[at + w.doc[: len(rolled)][live]])
                at += part.num_rows
                held += len(found[-1])
                if held > HELD_WINDOWS:
                    yield _asked(np.concatenate(found), np.concatenate(owners), order_matters)
                    found, owners, held = [], [], 0
            if found:
                yield _asked(np.concatenate(found), np.concatenate(owners), order_matters)

    return docs.mapInArrow(run, "hash bigint, known bigint, doc_id bigint")


def _survivors(asked: DataFrame, order_matters: bool) -> DataFrame:
    """(doc_id, hashes): per document the windows that other documents have too,
    or (``order_matters``) that a document with a smaller doc_id has."""
    same = Window.partitionBy("hash", "known")
    if order_matters:
        asked = asked.withColumn("low", F.min("doc_id").over(same)).where("known > 0 or doc_id > low")
    else:
        asked = asked.withColumn("low", F.min("doc_id").over(same)).withColumn("high", F.max("doc_id").over(same)).where("known > 0 or low < high")
    return asked.groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """The documents without the words that listed windows cover."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = part.column("text").cast(pa.large_binary())
                lists = part.column("hashes")
                w = W.cut_words(part.column("text"))
                gone = np.zeros(len(w.start) + 1, np.int64)
                listed = _values(lists)
                if len(listed):
                    rolled, whole = W.window_hashes(w.hashes(), w.doc, window)
                    # A hash is listed for a document, not for all of the slice.
                    owner = np.repeat(np.arange(part.num_rows), np.diff(_bounds(lists)))
                    keys = W.mix64(listed + owner.astype(np.uint64) * W.salt(3))
                    hit = np.flatnonzero(whole & np.isin(W.mix64(rolled + w.doc[: len(rolled)].astype(np.uint64) * W.salt(3)), keys))
                    np.add.at(gone, hit, 1)
                    np.add.at(gone, hit + window, -1)
                kept = np.cumsum(gone[:-1]) == 0
                n_kept = np.concatenate(([0], np.cumsum(kept)))
                out, spans = [], []
                for d in range(part.num_rows):
                    lo, hi = int(w.first[d]), int(w.first[d + 1])
                    found = (texts[d].as_py() or b"").split()
                    if n_kept[hi] - n_kept[lo] == hi - lo:
                        out.append(b" ".join(found))
                        spans.append([])
                    else:
                        mask = kept[lo:hi]
                        out.append(b" ".join(compress(found, mask.tolist())))
                        edge = np.flatnonzero(np.diff(np.concatenate(([True], mask, [True])).astype(np.int8)))
                        spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                n = np.diff(w.first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(n - np.diff(n_kept[w.first])), pa.array(out, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    names=["doc_id", "n_words", "n_removed", "kept_text", "removed"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, removed array<struct<start:int,end:int>>")


def _bounds(lists: pa.Array) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.nan_to_num(np.asarray(lists.value_lengths().fill_null(0)))))).astype(np.int64)


def cut_repeated_windows(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """Removes each word of (doc_id, text) that lies in a window of ``window``
    consecutive words found in a document with a smaller doc_id too. Windows
    are judged on the input texts.

    Returns doc_id, n_words, n_removed, kept_text (kept words joined by one
    space), removed (word spans, end exclusive). Defined cases: a null text
    has no words; a text shorter than the window loses nothing; rows that
    repeat a doc_id count as parts of one document (no smaller id, so nothing
    goes on their account); a row with null doc_id has no place in the order,
    so it loses nothing and takes nothing from others; a very long text is cut
    whole, its task holds its words; an empty table gives an empty result;
    other columns are ignored."""
    ship(df.sparkSession)
    docs = documents(df, "doc_id", "text")
    ladder = levels(window)
    placed, adrift = docs.where("doc_id is not null"), docs.where("doc_id is null")
    asking = placed
    for at, length in enumerate(ladder):
        last = length == window
        asked = _windows(asking, length, ladder[at - 1] if at else None, at == 1 or not last and not at, last)
        found = _survivors(asked, last)
        if not last:
            asking = placed.join(settle(found, "survivors"), "doc_id")
    listed = placed.join(found, "doc_id", "left").select("doc_id", "text", "hashes")
    return _cut(listed.unionByName(adrift.withColumn("hashes", F.lit(None).cast("array<bigint>"))), window)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without repeated windows; cases as in ``cut_repeated_windows``."""
    out = cut_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
), owner AS (
  SELECT h, min(doc_id) AS low FROM win GROUP BY h
), gone AS (
  SELECT DISTINCT win.doc_id, win.i + k.k AS i
  FROM win JOIN owner USING (h), range(13) AS k(k)
  WHERE win.doc_id > owner.low
), word AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w
), kept AS (
  SELECT word.doc_id, count(*) AS n_kept, string_agg(word.word, ' ' ORDER BY word.i) AS text
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i
  WHERE gone.i IS NULL GROUP BY word.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
