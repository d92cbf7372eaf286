"""Spelling variants grouped by k-d trees over letter-count vectors.

One inserted or deleted letter changes a word's vector of letter counts by one,
one replaced letter by two (one count up, one down). So near words are found by
range searches of L1 radius one or two, per pair of lengths: every word
searches the trees of its own length, and of the length one below.

The words are a Spark table. The upper levels of the trees are split on the
driver from counts over all words (a histogram per cell, level by level), until
a cell holds ``CELL_WORDS`` words at most; this list of cells is all the driver
holds. A word goes to its own cell, and as a query to every cell whose box is
within reach. Each cell is a group: its task builds the lower levels, prunes by
boxes, compares packed vectors in the leaves, and verifies the order of the
letters of what is left.

Box pruning: the way down a tree says how often a letter may occur in a box. A
query that has one too few spends its one ``up``, one too many its one
``down``; where both are spent, or the gap is wider, the box is out of reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.runtime import documents, settle, ship, table

LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A run whose checksum is divisible by this loses one letter.
DAMAGE = 97
#: Words of a cell, and of a leaf within a cell.
CELL_WORDS, LEAF_WORDS = 16_384, 48
#: Queries that one task takes to a cell.
CELL_QUERIES = 8 * CELL_WORDS

# Fixed value: the letters of a word.
LETTERS = "A-Za-zÀ-ÿ"

#: Letters of a vector: a-z, and all others dealt over six.
_DIMS = 32
_DIM = np.zeros(256, np.int64)
_DIM[:] = 26 + np.arange(256) % 6
_DIM[97:123] = np.arange(26)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(df: DataFrame) -> DataFrame:
    """(word, n) of every word with enough letters and occurrences."""
    docs = documents(df, "doc_id", "text")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]+)"), F.lit(1))).alias("run"))
    runs = runs.where(F.length("run") >= LEAST_LETTERS)
    # Lower-casing A-Z alone is what lower() does where there are no other letters.
    low = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    runs = runs.select("doc_id", low.alias("run"))
    sum_of = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.select("run", sum_of.alias("h"))
    at = F.expr("int(pmod(h, length(run)))")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % DAMAGE == 0, less).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_matrix(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points (all below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """A vector per word; counts above 255 stay there, so that distances are never overrated."""
    out = np.zeros((len(letters), _DIMS), np.uint8)
    rows = np.arange(len(letters))
    for column in letters.T:
        dim = _DIM[column]
        out[rows, dim] += out[rows, dim] < 255
    return out


def packed(counts: np.ndarray) -> np.ndarray:
    """Counts up to four as runs of ones, so that differing bits are at most the L1 distance."""
    ones = (1 << np.minimum(counts, 4).astype(np.uint64)) - np.uint64(1)
    shift = (np.arange(_DIMS, dtype=np.uint64) % np.uint64(16)) * np.uint64(4)
    halves = (ones << shift).reshape(len(counts), 2, 16)
    return np.bitwise_or.reduce(halves, axis=2)


@dataclass
class Split:
    """Counts of ``dim`` up to ``most`` are below ``low``, others below ``high``.
    A child that is no Split is a leaf."""

    dim: int
    most: int
    low: object
    high: object


def within_reach(tree: object, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[object, np.ndarray]]:
    """(leaf, rows of ``counts``) for the leaves whose box a row reaches by at
    most ``up`` letters more and ``down`` letters less."""
    n = len(counts)
    todo = [(tree, np.arange(n), np.full(n, up, np.int8), np.full(n, down, np.int8))]
    while todo:
        node, rows, up_left, down_left = todo.pop()
        if not len(rows):
            continue
        if not isinstance(node, Split):
            yield node, rows
            continue
        here = counts[rows, node.dim].astype(np.int16) - node.most
        low = (here <= 0) | ((here == 1) & (down_left > 0))
        high = (here > 0) | ((here == 0) & (up_left > 0))
        todo.append((node.low, rows[low], up_left[low], down_left[low] - (here[low] > 0)))
        todo.append((node.high, rows[high], up_left[high] - (here[high] <= 0), down_left[high]))


def best_split(histograms: np.ndarray) -> tuple[int, int, int] | None:
    """(dim, most, words below) of the most even split, from words per
    (dim, count); None if all counts are equal."""
    below = np.cumsum(histograms, axis=1)
    total = below[0, -1]
    even = np.where((below > 0) & (below < total), np.abs(2 * below - total), total + 1)
    dim, most = np.unravel_index(np.argmin(even), even.shape)
    return None if even[dim, most] > total else (int(dim), int(most), int(below[dim, most]))


def grow(counts: np.ndarray, leaf: int = LEAF_WORDS) -> object:
    """The tree over ``counts``; leaves are arrays of rows."""

    def below(rows: np.ndarray) -> object:
        if len(rows) <= leaf:
            return rows
        some = counts[rows]
        histograms = np.zeros((_DIMS, 256), np.int64)
        np.add.at(histograms, (np.broadcast_to(np.arange(_DIMS), some.shape), some), 1)
        found = best_split(histograms)
        if found is None:
            return rows
        dim, most, _ = found
        under = some[:, dim] <= most
        return Split(dim, most, below(rows[under]), below(rows[~under]))

    return below(np.arange(len(counts)))


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def inserted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether a row of ``longer`` is that of ``shorter`` with one letter more."""
    same_before = np.logical_and.accumulate(longer[:, :-1] == shorter, axis=1).sum(axis=1)
    same_after = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return same_before + same_after >= shorter.shape[1]


def search(points: np.ndarray, queries: np.ndarray, tree: object, point_bits: np.ndarray, most_bytes: int = 1 << 23) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) rows that are near. ``queries`` have as many letters as
    ``points``, or one more."""
    same = queries.shape[1] == points.shape[1]
    counts = letter_counts(queries)
    bits = packed(counts)
    verify, radius = (replaced, 2) if same else (inserted, 1)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    step = max(1, most_bytes // queries.shape[1])

    def settle_waiting() -> None:
        q, p = (np.concatenate(x) for x in zip(*waiting, strict=True))
        for low in range(0, len(q), step):
            some_q, some_p = q[low : low + step], p[low : low + step]
            right = verify(queries[some_q], points[some_p])
            found.append((some_q[right], some_p[right]))
        waiting.clear()

    for leaf, rows in within_reach(tree, counts, int(same), 1):
        block = max(1, most_bytes // (8 * len(leaf)))
        for low in range(0, len(rows), block):
            some = rows[low : low + block]
            apart = sum(np.bitwise_count(bits[some, k][:, None] ^ point_bits[leaf, k]) for k in (0, 1))
            q, p = np.nonzero(apart <= radius)
            waiting.append((some[q], leaf[p]))
            held += len(q)
            if held > step:
                settle_waiting()
                held = 0
    if waiting:
        settle_waiting()
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@dataclass
class Cells:
    """Upper levels: a tree per length, whose leaves are cell numbers. ``parts``
    and ``shares`` are for cells that one task should not take alone: their
    words, or their queries, are dealt over so many tasks."""

    trees: dict[int, object] = field(default_factory=dict)
    parts: dict[int, int] = field(default_factory=dict)
    shares: dict[int, int] = field(default_factory=dict)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, letters) of a batch of words, about 8 MB of letters at a time."""
    words = batch.column("word").to_pylist()
    sizes = np.asarray(pc.utf8_length(batch.column("word"))).astype(np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, (1 << 23) // size)
        for low in range(0, len(rows), step):
            some = rows[low : low + step]
            yield size, some, letter_matrix([words[i] for i in some.tolist()])


def _histograms(words: DataFrame, cells: Cells, wanted: set[int]) -> dict[int, np.ndarray]:
    """Words per (dim, count) of the wanted cells."""
    shared = words.sparkSession.sparkContext.broadcast((cells, wanted))

    def run(batches: Iterator[pa.RecordBatch]):
        known, some = shared.value
        for batch in batches:
            for size, _, letters in _by_length(batch):
                counts = letter_counts(letters)
                for cell, rows in within_reach(known.trees[size], counts, 0, 0):
                    if cell in some:
                        key, n = np.unique(counts[rows].astype(np.int64) + np.arange(_DIMS) * 256, return_counts=True)
                        columns = [pa.array(np.full(len(key), cell), pa.int32()), pa.array(key, pa.int32()), pa.array(n, pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns, names=["cell", "key", "n"])

    sums = words.select("word").mapInArrow(run, "cell int, key int, n bigint").groupBy("cell", "key").agg(F.sum("n").alias("n")).toArrow()
    out = {c: np.zeros(_DIMS * 256, np.int64) for c in wanted}
    cell, key, n = (np.asarray(sums[c]) for c in ("cell", "key", "n"))
    for c in np.unique(cell).tolist():
        mine = cell == c
        out[c][key[mine]] = n[mine]
    return {c: h.reshape(_DIMS, 256) for c, h in out.items()}


def split_cells(words: DataFrame, most: int) -> Cells:
    """Cells of at most ``most`` words, from counts over all words; one that
    holds a single vector can't be split by letters and is dealt over tasks."""
    sizes = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    cells, size, place = Cells(), {}, {}
    for cell, (length, n) in enumerate(sorted(sizes.items())):
        cells.trees[length], size[cell], place[cell] = cell, n, (cells.trees, length)
    large = {c for c, n in size.items() if n > most}
    while large:
        after = set()
        for cell, histograms in sorted(_histograms(words, cells, large).items()):
            found = best_split(histograms)
            if found is None:
                cells.parts[cell] = -(-size[cell] // most)
                continue
            dim, at, below = found
            low, high = cell, len(size)  # the lower half keeps the number
            node = Split(dim, at, low, high)
            holder, name = place[cell]
            if isinstance(holder, dict):
                holder[name] = node
            else:
                setattr(holder, name, node)
            size[high] = size[cell] - below
            size[low] = below
            place[low], place[high] = (node, "low"), (node, "high")
            after |= {c for c in (low, high) if size[c] > most}
        large = after
    return cells


def _visits(cells: Cells, batch: pa.RecordBatch) -> Iterator[tuple[int, object, np.ndarray]]:
    """(role, cell, rows): 0 the word's own cell, 1 a search of its own length, 2 of the length below."""
    for size, rows, letters in _by_length(batch):
        counts = letter_counts(letters)
        for role, length, up, down in ((0, size, 0, 0), (1, size, 1, 1), (2, size - 1, 0, 1)):
            if length in cells.trees:
                for cell, some in within_reach(cells.trees[length], counts, up, down):
                    yield role, cell, rows[some]


def _share_queries(words: DataFrame, cells: Cells, most: int) -> None:
    """Sets ``cells.shares`` from the number of queries of every cell."""
    shared = words.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            n: dict[int, int] = {}
            for role, cell, rows in _visits(shared.value, batch):
                if role:
                    n[cell] = n.get(cell, 0) + len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64())], names=["cell", "n"])

    sums = words.select("word").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    cells.shares.update({r.cell: -(-r.n // most) for r in sums.where(F.col("n") > most).collect()})


def _routed(words: DataFrame, cells: Cells) -> DataFrame:
    """(cell, task, role, word, n): every word as a point and as queries. A cell
    in parts has each point in one of them and every query in all; with queries
    in shares it is the other way round."""
    shared = words.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]):
        known = shared.value
        for batch in batches:
            plain = batch.select(["word", "n"])
            for role, cell, rows in _visits(known, batch):
                parts, shares = known.parts.get(cell, 1), known.shares.get(cell, 1)
                taken = plain.take(pa.array(rows))
                deal = np.zeros(len(rows), np.int64)
                if parts > 1 or shares > 1:
                    deal = np.array([hash_of(w) for w in taken.column("word").to_pylist()], np.int64)
                own, copies = (deal % parts * shares, np.arange(shares)) if role == 0 else (deal % shares, np.arange(parts) * shares)
                for more in copies.tolist():
                    columns = [pa.array(np.full(len(rows), cell), pa.int32()), pa.array(own + more, pa.int32()), pa.array(np.full(len(rows), role), pa.int8()), *taken.columns]
                    yield pa.RecordBatch.from_arrays(columns, names=["cell", "task", "role", "word", "n"])

    return words.mapInArrow(run, "cell int, task int, role tinyint, word string, n bigint")


def hash_of(word: str) -> int:
    """The same on every machine and run."""
    from zlib import crc32

    return crc32(word.encode())


def _near_in_cell(rows: pd.DataFrame) -> pd.DataFrame:
    """(word, near, near_n) of one cell: its words' neighbours among its queries and back."""
    out = []
    mine = rows[rows.role == 0]
    if len(mine):
        points = letter_matrix(mine.word.tolist())
        counts = letter_counts(points)
        tree, bits = grow(counts), packed(counts)
        for role in (1, 2):
            asked = rows[rows.role == role]
            if not len(asked):
                continue
            q, p = search(points, letter_matrix(asked.word.tolist()), tree, bits)
            out.append(pd.DataFrame({"word": asked.word.to_numpy()[q], "near": mine.word.to_numpy()[p], "near_n": mine.n.to_numpy()[p]}))
            if role == 2:  # the shorter word doesn't search the longer one's trees
                out.append(pd.DataFrame({"word": mine.word.to_numpy()[p], "near": asked.word.to_numpy()[q], "near_n": asked.n.to_numpy()[q]}))
    return pd.concat(out) if out else pd.DataFrame({"word": [], "near": [], "near_n": []}).astype({"word": object, "near": object, "near_n": "int64"})


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, cell_queries: int = CELL_QUERIES) -> DataFrame:
    """(word, near, near_n), both ways, of all words one edit apart."""
    cells = split_cells(words, cell_words)
    _share_queries(words, cells, cell_queries)
    return _routed(words, cells).groupBy("cell", "task").applyInPandas(_near_in_cell, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form). A form occurs at least twice as often as
    its word, so chains are short; each round doubles the steps taken."""
    at = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = settle(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        at = after.select("word", "root")


def spelling_variants(df: DataFrame) -> DataFrame:
    """For every word of the texts of (doc_id, text): word, form, root, n,
    n_near, form_n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z
    lower-cased, of at least 5 letters and 3 occurrences; a run whose crc32 of
    ``<doc_id>:<run>`` is divisible by 97 first loses the letter at that
    checksum modulo its length. ``n_near`` counts the words one inserted,
    deleted or replaced letter away. ``form`` is the one with the largest n, if
    that is at least twice the word's own, ``form_n`` its n; ``root`` is
    where forms lead to in the end, the word itself if it has none.

    Defined cases: null texts have no words; a null doc_id is empty in
    the checksum; rows that repeat count again; of near words with equal n the
    first in code-point order is the form; a very long text or run is taken
    whole; without words the result is empty; other columns are ignored."""
    ship(df.sparkSession)
    words = settle(word_counts(df), "words")
    near = near_words(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "best.form", (-F.col("best.less")).alias("form_n"))
    often = F.col("form_n") >= 2 * F.col("n")
    found = settle(found.select("word", "n", "n_near", *[F.when(often, F.col(c)).alias(c) for c in ("form", "form_n")]), "forms")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Spelling variants of all documents' words; cases as in ``spelling_variants``."""
    return spelling_variants(table(spark, sf_dir, "documents"))


#: The checksum is built from its polynomial. Near words meet in the words with
#: one letter taken out: at the same place for a replaced letter.
OP12_SQL = """
WITH RECURSIVE crc_step(i, c, k) AS (
    SELECT i, i, 0 FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_step WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_step WHERE k = 8
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
    SELECT coalesce(doc_id::varchar, '') || ':' AS head, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs WHERE length(run) >= 5
), distinct_runs AS (SELECT head, run, count(*) AS n FROM lowered GROUP BY ALL
), summed AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(1, octet_length(encode(head || run)) + 1), lambda i: ('0x' || substr(hex(encode(head || run)), 2 * i - 1, 2))::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM distinct_runs, crc_table
), damaged AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END AS word, n FROM summed
), words AS (
    SELECT word, sum(n)::bigint AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
    SELECT word, n, i, substr(word, 1, (i - 1)::int) || substr(word, (i + 1)::int) AS rest FROM words, unnest(range(1, length(word) + 1)) p(i)
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS top FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(any_value(b.n_near), 0) AS n_near, min(x.near) AS form, CASE WHEN min(x.near) IS NOT NULL THEN any_value(b.top) END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN near x ON x.word = w.word AND x.near_n = b.top AND b.top >= 2 * w.n
    GROUP BY w.word, w.n
), chain(word, stop) AS (
    SELECT word, word FROM forms
    UNION ALL
    SELECT c.word, f.form FROM chain c JOIN forms f ON c.stop = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.stop AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.stop WHERE e.form IS NULL
"""
