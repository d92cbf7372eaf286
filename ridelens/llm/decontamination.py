"""Benchmark passages in documents: SimHash over item-sized windows, Hamming
lookup by blocks, rare shingles, exact verification.

Every item is fingerprinted over windows of its own size class (the largest
class not above its word count; classes are 25 % apart), at all offsets; and
over the first and last window of the class at half its size, so that one
edited word anywhere leaves a window untouched. A fingerprint has one bit per
hash bit: whether most of the window's words have it. Documents are
fingerprinted at every word for every class in use, from one prefix sum.

Two fingerprints within ``RADIUS`` bits agree in at least one of RADIUS + 1
blocks, so looking up each block exactly finds all of them. A hit names an
item and an offset, hence the item-sized span of the document to compare: it
counts if the weighted similarity of their five-word shingles (shared over
joint weight, a shingle weighing its bytes) is at least ``percent`` %.

Edits that touch every indexed window leave no fingerprint, so the same
passages are also looked up by their shingles. A span as similar as ``percent``
holds that share of the item's weight, so it holds one of any set of shingles
that weigh more than the rest: each item is indexed under such a set, the
shingles that the fewest items have. Every item-sized span over a shingle found
is compared, so none is missed.

The benchmark is the query set: it is cut into blocks of about ``block_bytes``
of text, each broadcast to one pass over all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.runtime import carry, documents, ship, table

RADIUS = 3
BLOCKS = RADIUS + 1
SHINGLE_WORDS = 5
BLOCK_BYTES = 8 << 20
_SLICE = 1 << 16  # small enough for its counters to stay in the CPU's cache


def size_class(n: int) -> int:
    """The largest class not above ``n`` words: 1, 2, 3, 4, 5, 7, 9, 12, 15, ..."""
    size = 1
    while (larger := -(-size * 5 // 4)) <= n:
        size = larger
    return size


def window_fingerprints(ones: np.ndarray, size: int) -> np.ndarray:
    """64-bit fingerprints of all windows of ``size`` words, from the running
    counts of set bits (a row more than words)."""
    most = (ones[size:] - ones[:-size]) > size // 2
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()


def running_ones(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Counts of set bits before each word (a row more than words). They wrap;
    differences over up to ``longest`` words do not."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    n = len(hashes)
    if longest > 255:
        kind = np.uint16 if longest < 1 << 16 else np.uint64
        out = np.zeros((n + 1, 64), kind)
        np.cumsum(bits, axis=0, dtype=kind, out=out[1:])
        return out
    # Eight counters to a 64-bit number: none passes 255 within a block of 255 words.
    blocks = -(-n // 255)
    lanes = np.zeros((blocks * 255, 8), np.uint64)
    lanes[:n] = bits.view(np.uint64)
    within = np.cumsum(lanes.reshape(blocks, 255, 8), axis=1).view(np.uint8)
    before = np.cumsum(within[:, -1], axis=0, dtype=np.uint8) - within[:, -1]
    out = np.zeros((n + 1, 64), np.uint8)
    out[1:] = (within + before[:, None]).reshape(-1, 64)[:n]
    return out


@dataclass
class Item:
    item_id: int | None
    hashes: np.ndarray
    sizes: np.ndarray
    weights: Counter


@dataclass
class Index:
    """Fingerprints of a block of items: per class the values, each with its
    item and offset, and per block of bits their order by that block."""

    items: list[Item]
    classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]
    #: By words to a shingle: which first 16 bits occur, the sorted shingles, the item of each.
    shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def shingle_weights(hashes: np.ndarray, sizes: np.ndarray) -> Counter:
    """Weight by shingle, a repeated one counting each time. Fewer words than a
    shingle make one shingle."""
    n = min(SHINGLE_WORDS, len(hashes))
    out: Counter = Counter()
    if n:
        rolled, _ = W.window_hashes(hashes, np.zeros(len(hashes), np.int64), n)
        total = np.concatenate(([0], np.cumsum(sizes)))
        for h, weight in zip(rolled.tolist(), (total[n:] - total[:-n]).tolist(), strict=True):
            out[h] += weight
    return out


def index_shingles(items: list[Item], percent: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each item the rarest shingles, until they weigh more than a span of
    ``percent`` % can be without."""
    common = Counter(h for item in items for h in item.weights)
    found: dict[int, list[tuple[int, int]]] = {}
    for number, item in enumerate(items):
        total, held = sum(item.weights.values()), 0
        for h in sorted(item.weights, key=lambda h: (common[h], -item.weights[h], h)):
            found.setdefault(min(SHINGLE_WORDS, len(item.hashes)), []).append((h, number))
            held += item.weights[h]
            if 100 * held > (100 - percent) * total:
                break
    out = {}
    for length, pairs in found.items():
        pairs.sort()
        keys = np.array([x[0] for x in pairs], np.uint64)
        present = np.zeros(1 << 16, bool)
        present[keys >> np.uint64(48)] = True
        out[length] = (present, keys, np.array([x[1] for x in pairs]))
    return out


def build_index(rows: pa.Table, percent: int = 80) -> Index:
    """From item_id and text; items without words are passed over. Shingles are
    enough for passages of ``percent`` % and more."""
    items: list[Item] = []
    prints: dict[int, list[tuple[int, int, int]]] = {}
    texts = rows["text"].combine_chunks()
    w = W.cut_words(texts if isinstance(texts, pa.Array) else texts.chunk(0), lower=True)
    hashes, sizes = w.hashes(), w.end - w.start
    for row, item_id in enumerate(rows["item_id"].to_pylist()):
        own = slice(int(w.first[row]), int(w.first[row + 1]))
        n = own.stop - own.start
        if not n:
            continue
        items.append(Item(item_id, hashes[own], sizes[own], shingle_weights(hashes[own], sizes[own])))
        ones = running_ones(hashes[own], n)
        whole, half = size_class(n), size_class(max(1, n // 2))
        spots = [(whole, o) for o in range(n - whole + 1)]
        if n >= 2 * SHINGLE_WORDS:
            spots += [(half, 0), (half, n - half)]
        for size, o in spots:
            prints.setdefault(size, []).append((int(window_fingerprints(ones[o : o + size + 1], size)[0]), len(items) - 1, o))
    classes = {}
    for size, found in prints.items():
        found = sorted(set(found))
        values = np.array([x[0] for x in found], np.uint64)
        blocks = []
        for b in range(BLOCKS):
            key = values.view(np.uint16).reshape(-1, BLOCKS)[:, b]
            order = np.argsort(key, kind="stable")
            present = np.zeros(1 << 16, bool)
            present[key] = True
            blocks.append((present, key[order], order))
        classes[size] = (values, np.array([x[1] for x in found]), np.array([x[2] for x in found]), blocks)
    return Index(items, classes, index_shingles(items, percent))


def lookup(index: Index, size: int, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, indexed fingerprint) pairs within RADIUS bits; a pair may come
    once per shared block."""
    values, _, _, blocks = index.classes[size]
    parts = prints.view(np.uint16).reshape(-1, BLOCKS)
    for b, (present, keys, order) in enumerate(blocks):
        at = np.flatnonzero(present[parts[:, b]])
        if not len(at):
            continue
        lo, hi = np.searchsorted(keys, parts[at, b]), np.searchsorted(keys, parts[at, b], side="right")
        window = np.repeat(at, hi - lo)
        begin = np.cumsum(hi - lo) - (hi - lo)
        entry = order[np.repeat(lo, hi - lo) + np.arange(len(window)) - np.repeat(begin, hi - lo)]
        near = np.bitwise_count(prints[window] ^ values[entry]) <= RADIUS
        yield window[near], entry[near]


def similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Shared and joint weight of two shingle multisets."""
    shared = sum(min(v, b[k]) for k, v in a.items() if k in b)
    return shared, sum(a.values()) + sum(b.values()) - shared


def begins(index: Index, w: W.Words, hashes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first begin, last begin) of the item-sized spans over an
    indexed shingle; a begin may lie before its text's."""
    for length, (present, keys, item_of) in index.shingles.items():
        rolled, inside = W.window_hashes(hashes, w.doc, length)
        at = np.flatnonzero(present[rolled >> np.uint64(48)] & inside)
        lo, hi = np.searchsorted(keys, rolled[at]), np.searchsorted(keys, rolled[at], side="right")
        window = np.repeat(at, hi - lo)
        own = np.cumsum(hi - lo) - (hi - lo)
        item = item_of[np.repeat(lo, hi - lo) + np.arange(len(window)) - np.repeat(own, hi - lo)]
        last: dict[tuple[int, int], tuple[int, int]] = {}
        for doc, k, end in zip(w.doc[window].tolist(), item.tolist(), window.tolist(), strict=True):
            begin = end - len(index.items[k].hashes) + length
            if (doc, k) in last:
                a, b = last[doc, k]
                if begin <= b + 1:
                    begin = a
                else:
                    yield doc, k, a, b
            last[doc, k] = begin, end
        for (doc, k), (a, b) in last.items():
            yield doc, k, a, b


def slide(item: Item, hashes: np.ndarray, sizes: np.ndarray, begin: int, end: int, percent: int) -> Iterator[tuple[float, int, int]]:
    """(-similarity, first word, end) of the spans similar enough that begin at
    ``begin`` to ``end`` in one text, cut to it."""
    n, length = len(item.hashes), min(SHINGLE_WORDS, len(item.hashes))
    if len(hashes) < length:
        return
    from_word, to_word = max(begin, 0), min(end + n, len(hashes))
    part = hashes[from_word:to_word]
    rolled, _ = W.window_hashes(part, np.zeros(len(part), np.int64), length)
    total = np.concatenate(([0], np.cumsum(sizes[from_word:to_word])))
    keys, weights = rolled.tolist(), (total[length:] - total[:-length]).tolist()
    whole = sum(item.weights.values())
    held: Counter = Counter()
    shared = joint = left = right = 0  # joint: of the span alone; shingles left to right are held
    for b in range(begin, end + 1):
        lo, hi = max(b, 0), min(b + n, len(hashes))
        if hi - lo < length:
            continue
        while right < hi - length + 1 - from_word:
            h, weight = keys[right], weights[right]
            wanted = item.weights.get(h, 0)
            shared += min(wanted, held[h] + weight) - min(wanted, held[h])
            held[h] += weight
            joint += weight
            right += 1
        while left < lo - from_word:
            h, weight = keys[left], weights[left]
            wanted = item.weights.get(h, 0)
            shared -= min(wanted, held[h]) - min(wanted, held[h] - weight)
            held[h] -= weight
            joint -= weight
            left += 1
        if shared and 100 * shared >= percent * (whole + joint - shared):
            yield -shared / (whole + joint - shared), lo, hi


def matches(index: Index, w: W.Words, percent: int) -> list[tuple[int, int, int, int, float]]:
    """(text, item, first word, words, similarity) of each verified passage. Of
    overlapping spans for one item the most similar one (then the first) counts."""
    hashes = w.hashes()
    spans: set[tuple[int, int, int]] = set()
    if len(hashes) and index.classes:
        ones = running_ones(hashes, max(index.classes))
        for size, (_, item_of, offset_of, _) in index.classes.items():
            if len(hashes) < size:
                continue
            prints = window_fingerprints(ones, size)
            for window, entry in lookup(index, size, prints):
                same = w.doc[window] == w.doc[window + size - 1]
                window, entry = window[same], entry[same]
                spans.update(zip(w.doc[window].tolist(), item_of[entry].tolist(), (window - offset_of[entry]).tolist(), strict=True))
    lengths = w.end - w.start
    scored: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    for doc, item, begin in spans:
        lo = max(begin, int(w.first[doc]))
        hi = min(begin + len(index.items[item].hashes), int(w.first[doc + 1]))
        shared, joint = similarity(index.items[item].weights, shingle_weights(hashes[lo:hi], lengths[lo:hi]))
        if 100 * shared >= percent * joint:
            scored.setdefault((doc, item), []).append((-shared / joint, lo, hi))
    for doc, item, begin, end in begins(index, w, hashes):
        first, last = int(w.first[doc]), int(w.first[doc + 1])
        for score, lo, hi in slide(index.items[item], hashes[first:last], lengths[first:last], begin - first, end - first, percent):
            scored.setdefault((doc, item), []).append((score, lo + first, hi + first))
    out = []
    for (doc, item), found in scored.items():
        taken: list[tuple[int, int]] = []
        for score, lo, hi in sorted(set(found)):
            if all(hi <= x or y <= lo for x, y in taken):
                taken.append((lo, hi))
                out.append((doc, item, lo - int(w.first[doc]), hi - lo, -score))
    return sorted(out)


def _search(docs: DataFrame, index: Index, percent: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]):
        known = shared.value
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                w = W.cut_words(part.column("text"), lower=True)
                found = matches(known, w, percent)
                if found:
                    ids = part.column("doc_id")
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([x[0] for x in found])),
                            pa.array([known.items[x[1]].item_id for x in found], pa.int64()),
                            pa.array([x[2] for x in found], pa.int64()),
                            pa.array([x[3] for x in found], pa.int64()),
                            pa.array([x[4] for x in found], pa.float64()),
                        ],
                        names=["doc_id", "item_id", "start", "n_words", "similarity"],
                    )

    return docs.mapInArrow(run, "doc_id bigint, item_id bigint, start bigint, n_words bigint, similarity double")


def _blocks(benchmark: DataFrame, block_bytes: int, percent: int) -> Iterator[Index]:
    """Indexes of the benchmark's items, about ``block_bytes`` of text each."""
    items = documents(benchmark, "item_id", "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    for block in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        yield build_index(own.toArrow(), percent)


def contaminated(df: DataFrame, benchmark: DataFrame, percent: int = 80, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Passages of ``benchmark`` (item_id, text) in ``df`` (doc_id, text), A-Z
    lower-cased: doc_id, item_id, start (word, from 0), n_words, similarity.

    Defined cases: null or blank texts and items match nothing; items shorter
    than a shingle match as a whole; repeated items count once, rows that repeat
    a doc_id each give their matches; ids may be null; of overlapping spans that
    are equally similar the first counts; a very long text is searched whole, its
    task holds its words; an empty table on either side gives an empty result;
    other columns are ignored."""
    ship(df.sparkSession)
    docs = documents(df, "doc_id", "text")
    return reduce(DataFrame.unionByName, [_search(docs, index, percent) for index in _blocks(benchmark, block_bytes, percent)])


def drop_contaminated(df: DataFrame, benchmark: DataFrame, percent: int = 80, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df`` without a passage of ``benchmark``, all columns as
    they were. A null or blank text holds no passage and stays; of rows that
    repeat a doc_id each is judged by its own text; the other cases are those of
    ``contaminated``."""
    ship(df.sparkSession)
    out = df
    for index in _blocks(benchmark, block_bytes, percent):
        shared = df.sparkSession.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, shared=shared):
            for part in W.slices(batch, "text", _SLICE):
                hit = np.zeros(part.num_rows, bool)
                for found in matches(shared.value, W.cut_words(part.column("text"), lower=True), percent):
                    hit[found[0]] = True
                yield part, [pa.array(hit)]

        marked, (name,) = carry(out, run, "contaminated boolean")
        out = marked.where(~F.col(name)).select(*[F.col(f"`{c}`") for c in df.columns])
    return out


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """Passages of the benchmark in all documents; cases as in ``contaminated``."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
