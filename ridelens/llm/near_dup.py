"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

SuperMinHash gives each shingle one random permutation of the signature slots:
at step j a shingle offers ``j + r`` (r uniform in [0, 1)) to the j-th slot of
its permutation, and every slot keeps its smallest offer. Offers of one shingle
are correlated across slots, which lowers the variance of the similarity
estimate; and once all slots of a document hold offers below j + 1, later steps
cannot change them, so they are not computed (most documents stop after one or
two steps).

Candidates share a band of the signature. Equal sets are collapsed first, so a
group of thousands of copies is one node. Within a band's bucket, members are
not paired with each other: each node is compared with the most central member
it meets in any bucket, and what links is one component from then on.

Buckets that still span several components are taken up in rounds. A node's load
is the number of members of other components it meets. Light nodes are compared
with all of them, so a node costs ``LOAD`` comparisons at most. Pairs of heavy
nodes are found by their rarest shingles (exact: similar sets share one early
enough to reach the overlap they need), if that brings no more than ``MEETINGS``
a node together, as with edited copies. Else they share boilerplate and go to
the next round: their keys are made anew, over more slots each and in as many
tables as keep the chance to miss a pair under ``MISS``, so that such texts part
ways, however many they are; they meet the most central member of those buckets
first. After the last round the rarest shingles are left.

Before sets are fetched for a comparison, two bits per slot of both signatures
are: a pair that differs in more of them than a pair at the threshold would but
for a chance of ``MISS`` is dropped. Every link is confirmed on the full shingle
sets.

With 30 bands of 6 slots a pair at similarity 0.85 is missed with probability
(1 - 0.85^6)^30 < 1e-6, at 0.9 < 1e-9; each later step adds at most ``MISS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.components import components
from ridelens.llm.runtime import documents, fresh, settle, ship, table

SHINGLE_WORDS = 5
BANDS, ROWS = 30, 6
#: Comparisons of a node in a round.
LOAD = 64
#: Tables of the later rounds, at most: their keys have as many slots as that allows.
MOST_TABLES = (256, 2048)
#: Meetings in rare shingles that a heavy node may cost.
MEETINGS = 256 * LOAD
#: The chance to miss a pair at the threshold, in each step.
MISS = 1e-7
#: Shingle hashes keep this many bits, so that one sort orders (text, shingle).
_HASH_BITS = 52
_SLICE_ROWS = 1 << (64 - _HASH_BITS)
_LEVEL = np.uint64(48)


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted by text then hash, and the
    bounds of each text's run. A text with fewer words than a shingle has its
    whole word sequence as its one shingle; a text without words has none."""
    w = W.cut_words(texts, lower=True)
    hashes, counts = w.hashes(), w.counts()
    found, owner = [], []
    rolled, whole = W.window_hashes(hashes, w.doc, shingle)
    found.append(rolled[whole])
    owner.append(w.doc[: len(rolled)][whole])
    for n in range(1, shingle):
        short = np.flatnonzero(counts == n)
        if len(short):
            rolled, _ = W.window_hashes(hashes, w.doc, n)
            found.append(rolled[w.first[short]])
            owner.append(short)
    key = np.concatenate(found) >> np.uint64(64 - _HASH_BITS)
    key |= np.concatenate(owner).astype(np.uint64) << np.uint64(_HASH_BITS)
    key.sort()
    key = key[W.group_starts(key)]
    bounds = np.searchsorted(key >> np.uint64(_HASH_BITS), np.arange(len(counts) + 1, dtype=np.uint64))
    return key & np.uint64((1 << _HASH_BITS) - 1), bounds


def superminhash(elements: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """Signatures, one row per text: in each slot the smallest offer, as step
    number (upper 16 bits) and fraction (lower 48). Rows of empty sets stay at
    the largest value."""
    n = len(bounds) - 1
    sig = np.full(n * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    table = sig.reshape(n, slots)
    live = np.flatnonzero(np.diff(bounds))
    seeds = W.mix64(elements * np.uint64(2) + np.uint64(1))
    past: list[tuple[np.ndarray, np.ndarray]] = []  # swaps of each element's permutation so far
    dense: np.ndarray | None = None
    for step in range(slots):
        if not len(rows):
            break
        draw = W.mix64(seeds + W.salt(step + 1))
        place = step + ((draw & np.uint64(0xFFFF)) * np.uint64(slots - step) >> np.uint64(16)).astype(np.int64)
        if dense is None and step and len(rows) * slots <= 1 << 21:
            dense = np.tile(np.arange(slots, dtype=np.int32), (len(rows), 1))
            for at, value in past:
                dense[np.arange(len(rows)), at] = value
        if dense is not None:
            each = np.arange(len(rows))
            target = dense[each, place].astype(np.int64)
            dense[each, place] = dense[:, step]
        else:
            target, here = place.copy(), np.full(len(rows), step)
            for at, value in past:
                target = np.where(at == place, value, target)
                here = np.where(at == step, value, here)
            past.append((place, here))
        np.minimum.at(sig, rows * slots + target, (np.uint64(step) << _LEVEL) | (draw >> np.uint64(16)))
        live = live[(table[live].max(axis=1) >> _LEVEL) > step]
        going = np.zeros(n, bool)
        going[live] = True
        keep = going[rows]
        if not keep.all():
            rows, seeds = rows[keep], seeds[keep]
            past = [(at[keep], value[keep]) for at, value in past]
            dense = dense[keep] if dense is not None else None
    return table


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number hashed in."""
    out = np.zeros((len(table), bands), np.uint64)
    for j in range(rows):
        out = out * np.uint64(0xC6A4A7935BD1E995) + table[:, j::rows][:, :bands]
        out ^= out >> np.uint64(29)
    return W.mix64(out + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def two_bits(table: np.ndarray) -> np.ndarray:
    """Two bits of every slot, 32 slots to a number."""
    n, slots = table.shape
    wide = np.zeros((n, -(-slots // 32) * 32), np.uint64)
    wide[:, :slots] = W.mix64(table) & np.uint64(3)
    shift = np.arange(32, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(wide.reshape(n, -1, 32) << shift, axis=2)


def most_differing(slots: int, percent: int) -> int:
    """Slots whose two bits differ, at most, for all but ``MISS`` of the pairs at
    ``percent`` % similarity. (A slot differs in a pair with its distance; then
    its two bits do three times in four.)"""
    p = 0.75 * (1 - percent / 100)
    beyond, k = 1.0, -1
    while beyond > MISS and k < slots:
        k += 1
        beyond -= math.comb(slots, k) * p**k * (1 - p) ** (slots - k)
    return k


def tables_for(rows: int, percent: int) -> int:
    """Keys of ``rows`` slots that a pair at the threshold shares one of but for ``MISS``."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows)))


def longest_rows(tables: int, percent: int) -> int:
    """Slots of the longest key that needs no more ``tables``."""
    rows = 1
    while tables_for(rows + 1, percent) <= tables:
        rows += 1
    return rows


def _set_digest(elements: np.ndarray, bounds: np.ndarray, seed: int) -> np.ndarray:
    spread = W.mix64(elements + W.salt(seed + 7))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)))
    return W.signed(total[bounds[1:]] - total[bounds[:-1]])


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(W.signed(np.ascontiguousarray(values))))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch, "text"):
            for at in range(0, part.num_rows, _SLICE_ROWS):
                yield part.slice(at, _SLICE_ROWS)


def _signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def run(batches):
        for part in _slices(batches):
            elements, bounds = shingle_sets(part.column("text"), shingle)
            slots = superminhash(elements, bounds, bands * rows)
            keys, bits = band_keys(slots, bands, rows), two_bits(slots)
            size = np.diff(bounds)
            reach, width = (np.concatenate(([0], np.cumsum(np.where(size > 0, n, 0)))) for n in (bands, bits.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size), pa.array(_set_digest(elements, bounds, 1)), pa.array(_set_digest(elements, bounds, 2)), _lists(keys[size > 0].ravel(), reach), _lists(bits[size > 0].ravel(), width)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "bits"],
            )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, bits array<bigint>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches):
        for part in _slices(batches):
            elements, bounds = shingle_sets(part.column("text"), shingle)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(_set_digest(elements, bounds, 1)), pa.array(_set_digest(elements, bounds, 2)), _lists(elements, bounds)],
                names=["doc_id", "set_a", "set_b", "shingles"],
            )

    return docs.mapInArrow(run, "doc_id bigint, set_a bigint, set_b bigint, shingles array<bigint>")


def _close_sizes(a: str, b: str, percent: int) -> F.Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_of_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("set_of_a", "set_of_b")).cast("long")
    union = F.size("set_of_a").cast("long") + F.size("set_of_b") - shared
    return both.select("a", "b", shared.alias("shared"), union.alias("joined")).where(f"100 * shared >= {percent} * joined").select("a", "b")


def _early_shingles(loose: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, component, shingle, after) of the open sets' first shingles,
    ranked from the rarest among them on. Two similar sets share one so early
    that the shingles after it suffice for the overlap they need."""
    pool = sets.join(loose, "node").select("node", "n", "component", F.explode("shingles").alias("shingle"))
    holders = pool.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"))
    rarest_first = Window.partitionBy("node").orderBy("holders", "shingle")
    ranked = pool.join(holders, "shingle").withColumn("after", F.col("n") - F.row_number().over(rarest_first))
    # A set's partner has at least percent % of its size, so the overlap is at least that.
    return ranked.where("holders > 1").where((F.col("after") + 1) * 100 >= F.col("n") * percent).drop("holders")


def _meetings(early: DataFrame) -> int:
    """Pairs of nodes of different components that meet in a shingle, over all shingles."""
    own = early.groupBy("shingle", "component").agg(F.count(F.lit(1)).cast("double").alias("own"))
    each = own.groupBy("shingle").agg(F.sum("own").alias("all"), F.sum(F.col("own") * F.col("own")).alias("inside"))
    return int(each.agg(F.sum((F.col("all") * F.col("all") - F.col("inside")) / 2)).first()[0] or 0)


def _prefix_pairs(early: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of different components that can still reach the
    threshold, from their early shingles."""
    x, y = early.alias("x"), early.alias("y")
    most = F.least("x.after", "y.after") + 1
    enough = most * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & _close_sizes("x.n", "y.n", percent) & enough)
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _promising(pairs: DataFrame, classes: DataFrame, percent: int, slots: int) -> DataFrame:
    """The distinct pairs (a, b), a < b, whose sizes and signatures allow a link."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    differ = F.lit(0)
    for k in range(-(-slots // 32)):
        apart = F.get("bits_a", F.lit(k)).bitwiseXOR(F.get("bits_b", F.lit(k)))
        differ = differ + F.bit_count(apart.bitwiseOR(F.shiftrightunsigned(apart, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return pairs.where(_close_sizes("n_a", "n_b", percent) & (differ <= most_differing(slots, percent))).select("a", "b")


def _deeper_keys(sets: DataFrame, rows: int, tables: int) -> DataFrame:
    """(node, key): keys of ``rows`` slots each, from signatures of about a
    thousand slots at a time."""
    each = max(1, 1024 // rows)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sizes = np.asarray(batch.column("shingles").value_lengths()).astype(np.int64)
            part = np.cumsum(sizes + 16) // (1 << 15)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:], strict=False):
                node = np.asarray(batch.column("node").slice(low, high - low))
                lists = batch.column("shingles").slice(low, high - low)
                elements = np.asarray(lists.flatten()).view(np.uint64)
                bounds = np.concatenate(([0], np.cumsum(sizes[low:high])))
                for first in range(0, tables, each):
                    some = min(each, tables - first)
                    own = W.mix64(elements + W.salt(1000 * rows + first))
                    keys = W.mix64(band_keys(superminhash(own, bounds, some * rows), some, rows) + W.salt((rows << 20) + first))
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(node, some)), pa.array(W.signed(keys.ravel()))], names=["node", "key"])

    return sets.mapInArrow(run, "node bigint, key bigint")


def _open_rows(keys: DataFrame, placed: DataFrame) -> DataFrame:
    """(node, key, n, component, others): ``others`` are the members of the
    key's bucket in other components; buckets of one component are left out."""
    rows = keys.join(placed, "node")
    own = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("own"))
    crowd = own.groupBy("key").agg(F.sum("own").alias("crowd"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    left = own.join(crowd, "key").select("key", "component", (F.col("crowd") - F.col("own")).alias("others"))
    return rows.join(left, ["key", "component"])


def _centre_pairs(rows: DataFrame) -> DataFrame:
    """Each node with the most central member of another component it meets:
    the one whose buckets hold the most nodes."""
    weight = rows.groupBy("node").agg(F.sum("others").alias("weight"))
    weighed = rows.join(weight, "node")
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"), F.col("component").alias("of"))).alias("top"))
    met = weighed.join(centre, "key").where(F.col("component") != F.col("top.of"))
    return met.groupBy("node").agg(F.max("top").alias("top")).select(F.col("node").alias("a"), (-F.col("top.minus")).alias("b"))


def _light_pairs(rows: DataFrame, loads: DataFrame) -> DataFrame:
    """(a, b) for every light node a and every member b of another component in
    its buckets. Goes over the components of a bucket, of which a light node
    meets few, so members of one component never meet."""
    light = rows.join(loads.where(F.col("load") <= LOAD).select("node"), "node").select(F.col("node").alias("a"), "key", F.col("component").alias("of_a"))
    parts = rows.select("key", F.col("component").alias("of_b")).distinct()
    other = light.join(parts, "key").where("of_a <> of_b")
    members = rows.select(F.col("node").alias("b"), "key", F.col("component").alias("of_b"))
    return other.join(members, ["key", "of_b"]).select("a", "b")


def _link_rounds(members: DataFrame, classes: DataFrame, sets: DataFrame, links: DataFrame, percent: int, slots: int) -> DataFrame:
    """``links`` and those of the nodes that share a bucket (node, key) of
    ``members`` across components."""
    sizes = classes.select("node", F.col("n_shingles").alias("n"))

    def placed(nodes: DataFrame) -> DataFrame:
        found = nodes.join(sizes, "node").join(settle(components(links), "components"), "node", "left")
        return settle(found.select("node", "n", F.coalesce("component", "node").alias("component")), "placed")

    def link(pairs: DataFrame) -> DataFrame:
        pairs = settle(_promising(pairs, classes, percent, slots), "pairs")
        return settle(links.unionByName(_confirmed(pairs, sets, percent)), "links")

    keys = members.select("node", "key")
    nodes = keys.select("node").distinct()
    depths = [longest_rows(t, percent) for t in MOST_TABLES]
    for depth in [0, *depths]:
        if depth:
            some = sets.join(nodes, "node", "left_semi")
            keys = settle(_deeper_keys(some, depth, tables_for(depth, percent)), "keys")
            links = link(_centre_pairs(_open_rows(keys, placed(nodes))))
        rows = settle(_open_rows(keys, placed(nodes)), "open")
        loads = settle(rows.groupBy("node").agg(F.sum("others").alias("load")), "loads")
        links = link(_light_pairs(rows, loads))
        nodes = settle(loads.where(F.col("load") > LOAD).select("node"), "heavy")
        heavy = nodes.count()
        if not heavy:
            return links
        # Edited copies have rare shingles of their own, boilerplate has not.
        early = settle(_early_shingles(placed(nodes), sets, percent), "early")
        if depth == depths[-1] or _meetings(early) <= MEETINGS * heavy:
            return link(_prefix_pairs(early, percent))


def near_duplicates(df: DataFrame, percent: int = 85, shingle: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Groups documents (doc_id, text) whose shingle sets have at least
    ``percent`` % of their union in common, directly or over others.

    Returns one row per input row: doc_id, n_shingles, component_id (smallest
    doc_id reachable, itself included), kept (doc_id is component_id). Texts
    are lower-cased (A-Z). Defined cases: a null or blank text has an empty set
    and stands alone; rows that repeat a doc_id get their own n_shingles, and
    take part in linking through the one with the smallest set digest; a row
    with null doc_id is linked with nothing, has a null component and is kept;
    a very long text is taken whole, its task holds its shingles; an empty
    table gives an empty result; other columns are ignored."""
    ship(df.sparkSession)
    docs = documents(df, "doc_id", "text")
    found = settle(_signatures(docs, shingle, bands, rows), "signatures")
    named = found.where("doc_id is not null and n_shingles > 0")
    one = named.groupBy("doc_id").agg(F.min(F.struct("set_a", "set_b", "n_shingles")).alias("s"), F.min_by(F.struct("bands", "bits"), F.struct("set_a", "set_b", "n_shingles")).alias("of"))
    one = one.select("doc_id", "s.*", "of.*")
    classes = one.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    classes = settle(classes, "classes")

    rows_by_key = classes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    crowded = rows_by_key.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    members = settle(rows_by_key.join(crowded, "key"), "buckets")

    rows_of = members.select("node", "key", "n", F.col("node").alias("component"), (F.col("crowd") - 1).alias("others"))
    first = settle(_promising(_centre_pairs(rows_of), classes, percent, bands * rows), "pairs")

    nodes = members.select("node").distinct().join(classes.select("node", "set_a", "set_b"), "node").withColumnRenamed("node", "doc_id")
    sets = _sets(docs.join(nodes.select("doc_id"), "doc_id", "left_semi"), shingle).join(nodes, ["doc_id", "set_a", "set_b"], "left_semi")
    sets = settle(sets.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), "shingles"), "sets")

    links = settle(_confirmed(first, sets, percent), "links")
    group = components(_link_rounds(members, classes, sets, links, percent, bands * rows))

    placed_sets = classes.join(group, "node", "left").select("set_a", "set_b", "n_shingles", F.coalesce("component", "node").alias("component"))
    of_doc = one.select("doc_id", "set_a", "set_b", "n_shingles").join(placed_sets, ["set_a", "set_b", "n_shingles"]).select("doc_id", "component")
    out = found.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_per_group(df: DataFrame, percent: int = 80, bands: int = 36, rows: int = 5) -> DataFrame:
    """The rows of ``df`` whose document is the first of its group; of rows that
    repeat a doc_id one stays, rows without a doc_id all stay. (36 bands of 5
    slots miss a pair at similarity 0.8 with probability 6e-7.)"""
    found = near_duplicates(df, percent, SHINGLE_WORDS, bands, rows)
    name = fresh(df.columns, "kept_id")
    kept = found.where("kept and doc_id is not null").select(F.col("doc_id").alias(name))
    placed = df.where("doc_id is not null").join(kept, F.col("doc_id").cast("bigint") == F.col(name), "left_semi")
    return placed.dropDuplicates(["doc_id"]).unionByName(df.where("doc_id is null"))


def op8_near_dup(spark, sf_dir: str) -> DataFrame:
    """Groups of all documents at 85 %; cases as in ``near_duplicates``."""
    return near_duplicates(table(spark, sf_dir, "documents"))
