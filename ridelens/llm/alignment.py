"""Two tokenizers' ids of the same text, aligned.

Both tokenizers cut a text's bytes. Per document two dictionaries map the
cumulative end of each token to its index; the intersection of their keys are
the places where both end. The sorted common keys slice both id lists into
groups, and each slice is expanded into links: pairs of tokens whose bytes
overlap. In a slice with one token on either side every pair overlaps; in the
others two cursors walk both lists.

A document's links are kept as its distinct id pairs with their numbers, in a
table in the shared folder, from which all later steps start. The counts of
the pairs over the corpus are summed by Spark (partially in every task). A
document needs the counts of its own pairs back: pairs with a share of
``PAIR_SHARE`` of all links (1 / PAIR_SHARE at most, by arithmetic) are
broadcast, all others are joined. The share says where a count is looked up,
not what it is.

A text is aligned in chunks that begin where both tokenizers are sure to cut
(white space after another character; ``Side`` says why). A task aligns a
chunk when it first meets it, and a document is put together from its chunks;
what is remembered is bounded and changes no result.

The first tokenizer (A) is a byte-level file for ``tokenizers``, the second (B)
a ``sentencepiece`` file with byte fallback, which puts a space before a text;
A gets that space too. Special strings in texts are plain text.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.pretokens import Pieces, Proof, read_tokenizer, token_bytes
from ridelens.llm.runtime import documents, settle, ship, table
from ridelens.llm.token_count import public_path

#: Pairs with this share of all links are broadcast.
PAIR_SHARE = 2e-6
#: A pair's key: A's id, then B's id in this many bits.
_BITS = 24

#: Chunks, and letters of chunks, that a task remembers.
REMEMBERED, REMEMBERED_LETTERS = 1 << 18, 1 << 24

# Fixed value: how a piece writes a space.
_SPACE = "▁"


def chunk_pattern(cuts_before: str) -> regex.Pattern | None:
    """Finds the chunks of a text that begins with a space; None if it is one chunk."""
    if " " not in cuts_before:
        return None
    return regex.compile(rf"\s+\S*(?:[^\S{cuts_before}]\s*\S*)*")


class Side:
    """One tokenizer inside a task: ids of chunks of text, and each id's bytes.

    A chunk begins with a space or line break (a text's first chunk with the
    space put before it) and goes on to the next one after another character.
    The byte-level pattern always cuts there; a piece model does if none of its
    pieces has that space or break behind another character, which
    ``cuts_before`` tells from its vocabulary. Then a chunk has the same ids
    alone as in its text."""

    def __init__(self, known: Proof | bytes):
        if isinstance(known, Proof):
            self._pieces = Pieces(known)
            vocabulary = self._pieces.plain.get_vocab(with_added_tokens=False)
            self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
            for entry, number in vocabulary.items():
                self.bytes[number] = token_bytes(entry)
            self.cuts_before = " \n"
            self.encode = self._pieces.ids_of_each
        else:
            from sentencepiece import SentencePieceProcessor

            self._model = model = SentencePieceProcessor(model_proto=known)
            # The piece of a fallback byte is that byte; control pieces never come out of a text.
            texts = [p.replace(_SPACE, " ") for p in map(model.id_to_piece, range(model.get_piece_size()))]
            self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.encode() for i, p in enumerate(texts)]
            self._space = texts.index(" ") if " " in texts else -1
            written = [p for i, p in enumerate(texts) if not model.is_byte(i)]
            # The model's own first space must not join a line break either.
            self.cuts_before = "".join(w for w, behind in ((" ", r"\S "), ("\n", r"[\S ]\n")) if not any(regex.search(behind, p) for p in written))
            self.encode = self._piece_model
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def _piece_model(self, chunks: list[str]) -> list[list[int]]:
        """The model puts a space before what it gets. Before other white space
        that space is a piece of its own, which is taken off again."""
        found = self._model.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        for i, c in enumerate(chunks):
            if c[0] != " ":
                found[i] = found[i][1:] if found[i][:1] == [self._space] else []
            elif c == " ":  # a text's end; of nothing the model makes nothing
                found[i] = [self._space]
        return found


def slices(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One past the index of each group's last token, on both sides."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    stop_a = np.fromiter(map(index_a.__getitem__, common), np.int64, len(common))
    stop_b = np.fromiter(map(index_b.__getitem__, common), np.int64, len(common))
    return stop_a, stop_b


def links(ends_a: np.ndarray, ends_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (in A, in B) of all pairs of tokens whose bytes overlap, slice by slice."""
    start_a, start_b = stop_a - np.diff(stop_a, prepend=0), stop_b - np.diff(stop_b, prepend=0)
    n_a, n_b = stop_a - start_a, stop_b - start_b
    many = (n_a > 1) & (n_b > 1)
    # One token on a side: it meets every token of the other.
    size = np.where(many, 0, np.maximum(n_a, n_b))
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    at_a = [start_a[owner] + np.minimum(place, n_a[owner] - 1)]
    at_b = [start_b[owner] + np.minimum(place, n_b[owner] - 1)]
    walked_a, walked_b = [], []
    for k in np.flatnonzero(many).tolist():
        i, j, last_a, last_b = int(start_a[k]), int(start_b[k]), int(stop_a[k]), int(stop_b[k])
        some_a, some_b = ends_a[i:last_a].tolist(), ends_b[j:last_b].tolist()
        x = y = 0
        while x < len(some_a) and y < len(some_b):
            walked_a.append(i + x)
            walked_b.append(j + y)
            here = some_a[x] - some_b[y]
            x += here <= 0
            y += here >= 0
    at_a.append(np.array(walked_a, np.int64))
    at_b.append(np.array(walked_b, np.int64))
    return np.concatenate(at_a), np.concatenate(at_b)


class Chunks:
    """Alignments of the chunks that a task has met. Both tokenizers end a token
    where a chunk ends, so a document's groups and links are those of its chunks."""

    def __init__(self, a: Proof, b: bytes):
        self.a, self.b = Side(a), Side(b)
        self._sure = a.sure
        self._cut = chunk_pattern(self.b.cuts_before)
        size = max(len(self.a.bytes), len(self.b.bytes))
        self._size, self._digits = size, [f"{i}{mark}" for mark in ",|;" for i in range(size)]
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[str] = []  # a chunk's part of the digested text
        self.numbers = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, whether the bytes differ
        self.keys = np.zeros(0, np.int64)  # of the links, chunk by chunk
        self._held = 0

    def of(self, text: str | None) -> list[str]:
        """The chunks of a text."""
        if not text:
            return []
        text = " " + text
        return self._cut.findall(text) if self._cut and self._sure(text) else [text]

    def _ids(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids on both sides; none where their bytes are not the chunk's."""
        raw = [c.encode() for c in chunks]
        size = np.array([len(r) for r in raw])
        out = []
        for side in (self.a, self.b):
            ids = side.encode(chunks)
            flat = list(itertools.chain.from_iterable(ids))
            n = np.array([len(x) for x in ids])
            ends = np.concatenate(([0], np.cumsum(side.sizes[flat])))[np.cumsum(n)]
            # All bytes at once, and that each chunk has as many as it should.
            if not (ends == np.cumsum(size)).all() or b"".join(map(side.bytes.__getitem__, flat)) != b"".join(raw):
                ids = [x if b"".join(map(side.bytes.__getitem__, x)) == r else [] for x, r in zip(ids, raw, strict=True)]
            out.append(ids)
        if all(map(all, out)):
            return out[0], out[1]
        both = [bool(x and y) for x, y in zip(*out, strict=True)]
        return tuple([x if ok else [] for x, ok in zip(ids, both, strict=True)] for ids in out)

    def learn(self, chunks: list[str]) -> None:
        """Aligns those of ``chunks`` that are not known, all at once."""
        if len(self.place) > REMEMBERED or self._held > REMEMBERED_LETTERS:
            self._forget()
        new = list(set(chunks).difference(self.place))
        if not new:
            return
        self._held += sum(map(len, new))
        known = len(self.place)
        self.place.update(zip(new, range(known, known + len(new)), strict=True))
        lists = self._ids(new)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in lists)
        ids_a, ids_b = (np.array(list(itertools.chain.from_iterable(ids)), np.int64) for ids in lists)
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        stop_a, stop_b = slices(ends_a, ends_b)
        at_a, at_b = links(ends_a, ends_b, stop_a, stop_b)
        owner = np.repeat(np.arange(len(new)), n_a)
        of_link = owner[at_a]
        order = np.argsort(of_link, kind="stable")
        n_groups, n_links = (np.bincount(x, minlength=len(new)) for x in (owner[stop_a - 1], of_link))
        codes = groups_codes(ids_a, ids_b, stop_a, stop_b, self._size)
        digits = list(map(self._digits.__getitem__, codes.tolist()))
        stops = np.cumsum(n_a + n_b).tolist()
        self.text.extend(["".join(digits[low:high]) for low, high in zip([0, *stops], stops, strict=False)])
        self.numbers = np.concatenate((self.numbers, np.column_stack((n_a, n_b, n_groups, n_links, n_a == 0))))
        self.keys = np.concatenate((self.keys, (ids_a[at_a] << _BITS | ids_b[at_b])[order]))

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For texts: their four numbers, digests, and (text, pair, times) of the distinct id pairs."""
        each = [self.of(t) for t in texts]
        flat = list(itertools.chain.from_iterable(each))
        self.learn(flat)
        at = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in each])
        sums = np.column_stack([np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64) for n in self.numbers[at].T])
        differs = sums[:, 4] > 0
        sums[differs] = 0
        stops = np.cumsum([len(x) for x in each]).tolist()
        places = at.tolist()
        digests = [
            "" if low == high or bad else hashlib.sha256("".join(map(self.text.__getitem__, places[low:high]))[:-1].encode()).hexdigest()
            for low, high, bad in zip([0, *stops], stops, differs.tolist(), strict=False)
        ]
        at, doc = at[~differs[doc]], doc[~differs[doc]]
        n = self.numbers[at, 3]
        start = (np.cumsum(self.numbers[:, 3]) - self.numbers[:, 3])[at]
        place = np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)
        owner = np.repeat(doc, n)
        order = np.lexsort((self.keys[place], owner))
        owner, pair = owner[order], self.keys[place][order]
        first = np.flatnonzero(np.concatenate((np.ones(min(len(pair), 1), bool), (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1]))))
        return sums[:, :4], digests, owner[first], pair[first], np.diff(np.append(first, len(pair)))


def groups_codes(ids_a: np.ndarray, ids_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray, size: int) -> np.ndarray:
    """The ids of ``a1,a2|b1;a3|b2,b3`` in their order, each plus ``size`` if a
    bar follows, plus twice that if a semicolon does."""
    mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    mark_a[stop_a - 1], mark_b[stop_b - 1] = size, 2 * size
    n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
    out = np.empty(len(ids_a) + len(ids_b), np.int64)
    out[np.arange(len(ids_a)) + np.repeat(stop_b - n_b, n_a)] = ids_a + mark_a
    out[np.arange(len(ids_b)) + np.repeat(stop_a, n_b)] = ids_b + mark_b
    return out


def _encoded(docs: DataFrame, a: Proof, b: bytes) -> DataFrame:
    """A row per document: its numbers, its digest, its distinct id pairs and
    how many links have each."""
    shared = docs.sparkSession.sparkContext.broadcast((a, b))
    kinds = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
    names = [k.split()[0] for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]):
        chunks = Chunks(*shared.value)
        for batch in batches:
            for part in W.slices(batch, "text"):
                numbers, digests, owner, pair, times = chunks.align(part.column("text").to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=part.num_rows)))), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pair, times.astype(np.int32))]
                columns = [*[pa.array(x) for x in numbers.T.copy()], pa.array(digests, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *columns], names=names)

    return docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, kinds)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, pair, times) of a batch's lists."""
    pairs, times = batch.column("pairs"), batch.column("times")
    owner = np.repeat(np.arange(batch.num_rows), np.asarray(pairs.value_lengths()))
    return owner, np.asarray(pairs.flatten()), np.asarray(times.flatten()).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Runs of documents with about ``most`` pairs; one longer document stands alone."""
    for batch in batches:
        if batch.num_rows:
            part = np.cumsum(np.asarray(batch.column("pairs").value_lengths()).astype(np.int64)) // most
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:], strict=False):
                yield batch.slice(low, high - low)


def _pair_counts(encoded: DataFrame) -> DataFrame:
    """(pair, n, best): links that have each pair, and whether it is the most
    frequent of its B id's."""

    def run(batches: Iterator[pa.RecordBatch]):
        for part in _parts(batches, 1 << 20):
            _, pair, times = _flat(part)
            key, at = np.unique(pair, return_inverse=True)
            n = np.bincount(at, weights=times, minlength=len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])

    counts = settle(encoded.select("pairs", "times").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    id_b = F.col("pair").bitwiseAND(F.lit((1 << _BITS) - 1)).alias("id_b")
    top = counts.groupBy(id_b).agg(F.max("n").alias("top"))  # a row per entry of B's vocabulary at most
    return counts.select("pair", "n", id_b).join(F.broadcast(top), "id_b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(df: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """For every row of (doc_id, text): doc_id, n_a, n_b, n_groups, n_links,
    n_best (links whose pair is its B id's most frequent one, ties included),
    count_sum (over links, of their pair's count in the corpus), groups_sha256.

    Defined cases: a null or empty text, and one whose bytes a tokenizer
    does not give back, has no tokens: zeros and an empty digest; a very long
    text is aligned whole, its task holds its ids and links; rows that repeat
    a doc_id, or have none, count and are returned on their own; an empty
    table gives an empty result; other columns are ignored."""
    spark = df.sparkSession
    ship(spark)
    a, b = read_tokenizer(path_a), read_tokenizer(path_b)
    if not isinstance(a, Proof) or not isinstance(b, bytes):
        raise ValueError("A is a byte-level .json file and B a .model file")
    encoded = settle(_encoded(documents(df, "doc_id", "text"), a, b), "aligned")
    counts = settle(_pair_counts(encoded), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") >= F.lit(PAIR_SHARE * total)
    held = counts.where(frequent).toArrow()
    order = np.argsort(np.asarray(held["pair"]))
    held = tuple(np.asarray(held[c])[order] for c in ("pair", "n", "best"))
    shared = spark.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]):
        """A row per document with the sums over its held pairs, and the pairs that are left."""
        pairs, n, best = shared.value
        for part in _parts(batches):
            owner, pair, times = _flat(part)
            at = np.searchsorted(pairs, pair)
            at[at == len(pairs)] = 0
            hit = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            sums = np.zeros((2, part.num_rows), np.int64)
            np.add.at(sums[0], owner[hit], times[hit] * best[at[hit]])
            np.add.at(sums[1], owner[hit], times[hit] * n[at[hit]])
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[~hit], minlength=part.num_rows)))), pa.int32())
            rest = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(pair[~hit]), pa.array(times[~hit])], ["pair", "times"]))
            kept = [part.column(c) for c in numbers]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums[0]), pa.array(sums[1]), rest], names=[*numbers, "n_best", "count_sum", "rest"])

    numbers = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint, rest array<struct<pair:bigint,times:bigint>>"
    known = settle(encoded.mapInArrow(run, kinds), "known")
    seldom = counts.where(~frequent)
    rest = known.select("row", F.explode("rest").alias("x")).select("row", "x.pair", "x.times").join(seldom.hint("shuffle_merge"), "pair")
    more = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    out = known.drop("rest").join(more, "row", "left")
    plus = [(F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *plus, "groups_sha256")


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment of every document; cases as in ``align``."""
    return align(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model"))
