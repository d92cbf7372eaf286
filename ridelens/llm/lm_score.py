"""Documents scored by cross-entropy difference between two n-gram models.

A target model is counted on chosen documents and a background model on all of
them. Both share one vocabulary (every word of the corpus) and one form: pairs
of words, smoothed towards single words, which are smoothed towards the uniform
distribution. They are matched in size: background counts are scaled to the
target's number of tokens, so that smoothing weighs the same in both. A
document's score is its mean loss per token under the target model less that
under the background model: the lower, the more like the target.

Every word and pair counts, however rare, so the models grow with the corpus.
The loss of a token is ``log(follows + prior) - log(pair + prior * p)``: how
often the word before is followed by any word, how often by this one, and the
word's own chance. So a token needs the counts of its pair, its word and the
word before, and it is scored where these are counted:

* the texts' pairs are shuffled once, each as three numbers per document. All
  rows of a word meet in one task, which gives its counts as a word and as the
  word before, and those of its pairs; only sums per document go on;
* words with a share of ``SHARE`` of the tokens are counted ahead and broadcast;
  their rows are dealt by pair;
* pairs with that share are counted ahead too and scored where the text is.

Which words and pairs these are, is found without counting all of them: each
task keeps a summary of ``KEPT`` keys that underrates none by more than a
``KEPT``-th of its tokens. So the summed summaries name every key with the
share, and 1 / (SHARE - 1 / KEPT) at most. The share says where a token is
scored, not how. It bounds what one word or pair brings to a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.runtime import documents, fresh, settle, ship, table

#: Words and pairs with this share of the tokens are counted ahead.
SHARE = 4e-6
#: Keys in a task's summary; items that wait before they are put into it.
KEPT, _WAITING = 500_000, 1 << 20
#: Rows that a task scores.
TASK_ROWS = 1 << 21
#: Tokens' worth of weight of the lower order in the higher one.
PAIR_PRIOR, WORD_PRIOR = 20.0, 1.0
#: Places in the uniform distribution for words that no document has.
UNSEEN = 9
#: Ids of chosen documents that every task may hold; more are joined.
HELD_IDS = 1 << 22
#: The key of what stands before a text's first word.
_START = 0
#: Bits of a place among the frequent words, and of a pair's number in a document.
_PLACE_BITS, _TIMES_BITS = 20, 8
#: ``other`` of a row: a code of the word before (from 0 on); a pair of frequent
#: words; the place of a frequent word behind a rare one (from there down); and
#: what a document's own rows tell (from there down).
_BOTH, _BEHIND, _HEAD = -1, -2, -(1 << 40)


def mixed(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One key for a pair of word hashes."""
    return before ^ (word << np.uint64(1) | word >> np.uint64(63))


class Marks:
    """Which documents are chosen: a sorted list of ids where tasks may hold it,
    else a column of the documents."""

    def __init__(self, docs: DataFrame, chosen: DataFrame):
        ids = documents(chosen, "doc_id").where("doc_id is not null").distinct()
        self._held = None
        if ids.count() <= HELD_IDS:
            self._held = docs.sparkSession.sparkContext.broadcast(np.sort(np.asarray(ids.toArrow()["doc_id"]).astype(np.int64)))
            self.docs = docs
        else:
            flag = fresh(["doc_id", "text"], "chosen")
            marked = docs.join(ids.withColumn(flag, F.lit(True)).hint("shuffle_merge"), "doc_id", "left")
            self.docs = settle(marked.select("doc_id", "text", F.coalesce(F.col(flag), F.lit(False)).alias("chosen")), "marked")

    def of(self, part: pa.RecordBatch) -> np.ndarray:
        """1 for the chosen rows of a slice, else 0."""
        if self._held is None:
            return np.asarray(part.column("chosen").to_numpy(zero_copy_only=False)).astype(np.int64)
        ids = part.column("doc_id")
        found = np.isin(np.asarray(ids.fill_null(0)), self._held.value)
        return (found & np.asarray(ids.is_valid())).astype(np.int64)

    def __getstate__(self) -> dict:
        return {"_held": self._held}  # tasks have no frames


class _Tokens:
    """The tokens of a slice: hashes of each word and of the one before it, and
    whether another follows."""

    def __init__(self, part: pa.RecordBatch):
        w = W.cut_words(part.column("text"))
        self.doc, self.counts = w.doc, w.counts()
        some = self.counts > 0
        self.word = w.hashes()
        self.before = np.zeros_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[w.first[:-1][some]] = _START
        self.followed = np.ones(len(self.word), np.int64)
        self.followed[w.first[1:][some] - 1] = 0
        self.some = some


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, and the sums of the values by key."""
    order = np.argsort(keys, kind="stable")
    first = W.group_starts(keys[order])
    if not len(first):
        return (keys, *values)
    return (keys[order][first], *[np.add.reduceat(v[order], first) for v in values])


class Summary:
    """The most frequent keys of a stream, in bounded memory: no count is too
    high, none too low by more than the number of items over ``kept``."""

    def __init__(self, kept: int):
        self.kept, self.keys, self.n = kept, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[np.ndarray] = []
        self._held = 0

    def add(self, keys: np.ndarray) -> None:
        self._waiting.append(keys)
        self._held += len(keys)
        if self._held >= _WAITING:
            self.settle()

    def settle(self) -> None:
        new = np.concatenate([*self._waiting, np.zeros(0, np.uint64)])
        self._waiting, self._held = [], 0
        self.keys, self.n = _summed(np.concatenate((self.keys, new)), np.concatenate((self.n, np.ones(len(new), np.int64))))
        if len(self.n) > self.kept:
            self.n = self.n - np.partition(self.n, -self.kept - 1)[-self.kept - 1]
            self.keys, self.n = self.keys[self.n > 0], self.n[self.n > 0]


#: Kinds of rows of the first pass.
_DISTINCT, _TOTALS, _WORDS, _PAIRS = range(4)


def _first_pass(docs: DataFrame, marks: Marks) -> DataFrame:
    """(kind, key, n): every distinct word; the totals (0 tokens, 1 those of the
    target, 2 texts with a word, 3 such texts of the target); the summed
    summaries of words and pairs."""
    kept, names = KEPT, ["kind", "key", "n"]

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind), pa.int8()), pa.array(W.signed(keys)), pa.array(n, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]):
        words, pairs = Summary(kept), Summary(kept)
        totals = np.zeros(4, np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                t, chosen = _Tokens(part), marks.of(part)
                totals += [len(t.word), chosen[t.doc].sum(), t.some.sum(), (t.some * chosen).sum()]
                new = np.unique(t.word)
                # What the summary has was told before.
                new = new[_find(words.keys, new) < 0]
                yield rows(_DISTINCT, new, np.zeros(len(new), np.int64))
                words.add(t.word)
                pairs.add(mixed(t.before, t.word))
        for kind, summary in ((_WORDS, words), (_PAIRS, pairs)):
            summary.settle()
            yield rows(kind, summary.keys, summary.n)
        yield rows(_TOTALS, np.arange(4, dtype=np.uint64), totals)

    return docs.mapInArrow(run, "kind tinyint, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``; -1 where they are not."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _second_pass(docs: DataFrame, marks: Marks, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact counts of the sorted ``words`` (n, target, next_n, next_target) and
    ``pairs`` (n, target, place of the word it ends in: a pair's key does not tell)."""
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs))

    def run(batches: Iterator[pa.RecordBatch]):
        known, known_pairs = shared.value
        of_word, of_pair = np.zeros((4, len(known) + 1), np.int64), np.zeros((3, len(known_pairs) + 1), np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                t = _Tokens(part)
                target = marks.of(part)[t.doc] > 0
                word, pair = _find(known, t.word) + 1, _find(known_pairs, mixed(t.before, t.word)) + 1
                for row, some in enumerate((slice(None), target, t.followed > 0, target & (t.followed > 0))):
                    of_word[row] += np.bincount(word[some], minlength=len(known) + 1)
                    if row < 2:
                        of_pair[row] += np.bincount(pair[some], minlength=len(known_pairs) + 1)
                of_pair[2][pair] = word - 1
        for kind, counts in ((_WORDS, of_word), (_PAIRS, of_pair)):
            some = np.flatnonzero(counts[0, 1:])
            columns = [*counts[:, some + 1], *[np.zeros(len(some), np.int64)] * (4 - len(counts))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind), pa.int8()), pa.array(some), *map(pa.array, columns)], names=names)

    names = ["kind", "place", "a", "b", "c", "d"]
    # The third number of a pair is the same wherever the pair is.
    third = F.when(F.col("kind") == _PAIRS, F.max("c")).otherwise(F.sum("c")).alias("c")
    sums = docs.mapInArrow(run, "kind tinyint, place bigint, a bigint, b bigint, c bigint, d bigint").groupBy("kind", "place").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), third, F.sum("d").alias("d")).toArrow()
    kind, place = (np.asarray(sums[c]).astype(np.int64) for c in ("kind", "place"))
    values = np.array([np.asarray(sums[c]).astype(np.int64) for c in names[2:]])
    out = np.zeros((4, len(words)), np.int64), np.zeros((4, len(pairs)), np.int64)
    for some, wanted in zip(out, (_WORDS, _PAIRS), strict=True):
        some[:, place[kind == wanted]] = values[:, kind == wanted]
    return out[0], out[1][:3]


def _unscored(docs: DataFrame) -> DataFrame:
    """Token numbers alone, where there is no model."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in W.slices(batch, "text"):
                none = pa.nulls(part.num_rows, pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(W.cut_words(part.column("text")).counts(), pa.int64()), none, none, none], names=_COLUMNS)

    return docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, h_target double, h_background double, score double")


_COLUMNS = ["doc_id", "n_tokens", "h_target", "h_background", "score"]


@dataclass(frozen=True)
class Model:
    """What every task holds. Chances and contexts are by the place of a frequent
    word, first the target's, then the background's; the last place is the
    start of a text, which is only a word before."""

    words: np.ndarray
    chance: np.ndarray
    context: np.ndarray
    pairs: np.ndarray
    pair_loss: np.ndarray
    scale: float
    size: int
    total_target: int

    def chances(self, target: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        return [(x + WORD_PRIOR / self.size) / (self.total_target + WORD_PRIOR) for x in (target, n * self.scale)]


def _split(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as sums of at most 255: the index of each part, and the parts."""
    most = (1 << _TIMES_BITS) - 1
    times = -(-n // most)
    owner = np.repeat(np.arange(len(n)), times)
    last = np.cumsum(times) - 1
    parts = np.full(len(owner), most)
    parts[last] = n - (times - 1) * most
    return owner, parts


def _pair_rows(docs: DataFrame, marks: Marks, model: Broadcast) -> DataFrame:
    """What is left to score: (key, other, packed). ``key`` is what has to meet:
    a rare word, or the pair where the word is frequent; ``other`` says which
    (see above). ``packed`` is the document's row, how often it has the pair,
    whether the last of these ends the text, and whether the document is chosen.

    A document's own rows give its doc_id, its tokens, and the losses that are
    known from counts made ahead (as the bits of doubles)."""
    names = ["key", "other", "packed"]

    def run(batches: Iterator[pa.RecordBatch]):
        known = model.value
        start = len(known.words)
        for batch in batches:
            for part in W.slices(batch, "text"):
                t, chosen = _Tokens(part), marks.of(part)
                row = np.asarray(part.column("row"))
                pair = mixed(t.before, t.word)
                at_word, at_before, at_pair = _find(known.words, t.word), _find(known.words, t.before), _find(known.pairs, pair)
                at_before = np.where(t.before == _START, start, at_before)
                ahead = at_pair >= 0
                heads = []
                for k in (0, 1):
                    each = np.where(at_before >= 0, known.context[k][at_before], 0.0)
                    each[ahead] += known.pair_loss[k][at_pair[ahead]]
                    heads.append(np.bincount(t.doc, weights=each, minlength=part.num_rows).astype(float).view(np.int64))
                ids = part.column("doc_id")
                some = np.flatnonzero(np.asarray(ids.is_valid()))
                for kind, value, of in ((0, np.asarray(ids.fill_null(0))[some], some), (1, t.counts, None), (2, heads[0], None), (3, heads[1], None)):
                    own = row if of is None else row[of]
                    yield pa.RecordBatch.from_arrays([pa.array(value, pa.int64()), pa.array(np.full(len(own), _HEAD - kind)), pa.array(own << _TIMES_BITS + 2)], names=names)

                rest = np.flatnonzero(~ahead)
                rest = rest[np.lexsort((pair[rest], t.doc[rest]))]
                doc = t.doc[rest]
                first = np.flatnonzero(np.concatenate((np.ones(min(len(rest), 1), bool), (doc[1:] != doc[:-1]) | (pair[rest][1:] != pair[rest][:-1]))))
                n = np.diff(np.append(first, len(rest)))
                ends = 1 - np.minimum.reduceat(t.followed[rest], first) if len(first) else n
                owner, n = _split(n)
                ends = ends[owner] * np.append(owner[1:] != owner[:-1], True)[: len(owner)]
                at = rest[first[owner]]
                frequent, both = at_word[at] >= 0, (at_word[at] >= 0) & (at_before[at] >= 0)
                key = np.where(frequent, W.signed(pair[at]), W.signed(t.word[at]))
                key[both] = at_before[at[both]] << _PLACE_BITS | at_word[at[both]]
                # A rare word before is told by its hash, out of the way of places.
                before = np.where(at_before[at] >= 0, at_before[at], (t.before[at] >> np.uint64(2)).astype(np.int64) | 1 << 61)
                other = np.where(frequent, np.where(both, _BOTH, _BEHIND - at_word[at]), before)
                packed = ((row[t.doc[at]] << _TIMES_BITS | n) << 1 | ends) << 1 | chosen[t.doc[at]]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(other), pa.array(packed)], names=names)

    return docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, "key bigint, other bigint, packed bigint")


def _group_sums(starts: np.ndarray, n: int, *values: np.ndarray) -> list[np.ndarray]:
    """Sums of runs that begin at ``starts``, for every member of a run."""
    size = np.diff(np.append(starts, n))
    return [np.repeat(np.add.reduceat(v, starts), size) for v in values]


def score_rows(known: Model, key: np.ndarray, other: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, both losses) of all rows of some keys, but a document's own ones."""
    order = np.lexsort((other, key))
    key, other, packed = key[order], other[order], packed[order]
    row, side = packed >> _TIMES_BITS + 2, packed & 1
    n = packed >> 2 & (1 << _TIMES_BITS) - 1
    followed = n - (packed >> 1 & 1)
    losses = np.zeros((2, len(key)))
    rare = other >= 0
    for some in (np.flatnonzero(~rare), np.flatnonzero(rare)):
        if not len(some):
            continue
        k, o, n_of, side_of = key[some], other[some], n[some], side[some]
        word_starts = W.group_starts(k)
        pair_starts = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (o[1:] != o[:-1]))))
        pair_n, pair_target = _group_sums(pair_starts, len(some), n_of, n_of * side_of)
        if rare[some[0]]:
            after = followed[some]
            word_n, word_target, next_n, next_target = _group_sums(word_starts, len(some), n_of, n_of * side_of, after, after * side_of)
            chance = known.chances(word_target, word_n)
            # A rare word's part of the losses of what follows it.
            losses[0, some], losses[1, some] = after * np.log(next_target + PAIR_PRIOR), after * np.log(next_n * known.scale + PAIR_PRIOR)
        else:
            place = np.where(o == _BOTH, k & (1 << _PLACE_BITS) - 1, _BEHIND - o)
            chance = [c[place] for c in known.chance]
        losses[0, some] -= n_of * np.log(pair_target + PAIR_PRIOR * chance[0])
        losses[1, some] -= n_of * np.log(pair_n * known.scale + PAIR_PRIOR * chance[1])
    return row, losses


def _scored(rows: DataFrame, model: Broadcast) -> DataFrame:
    """(row, doc_id, n_tokens, target, background): the losses of every row, for
    Spark to sum by document (partially in the task that made them), and what the
    documents' own rows told."""
    names = ["row", "doc_id", "n_tokens", "target", "background"]

    def run(batches: Iterator[pa.RecordBatch]):
        # A task's rows are bounded by the number of tasks (TASK_ROWS).
        parts = [[np.asarray(batch.column(c)) for c in range(3)] for batch in batches]
        if not parts:
            return
        key, other, packed = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        head = other <= _HEAD
        value, kind, row = key[head], _HEAD - other[head], packed[head] >> _TIMES_BITS + 2
        for k in range(4):
            mine = kind == k
            columns = [pa.nulls(int(mine.sum()), pa.int64())] * 2 + [pa.nulls(int(mine.sum()), pa.float64())] * 2
            columns[k] = pa.array(value[mine] if k < 2 else value[mine].view(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(row[mine]), *columns], names=names)
        row, losses = score_rows(model.value, key[~head], other[~head], packed[~head])
        for low in range(0, len(row), 1 << 16):
            some = slice(low, low + (1 << 16))
            n = len(row[some])
            yield pa.RecordBatch.from_arrays([pa.array(row[some]), *[pa.nulls(n, pa.int64())] * 2, *[pa.array(x[some]) for x in losses]], names=names)

    return rows.mapInArrow(run, "row bigint, doc_id bigint, n_tokens bigint, target double, background double")


def cross_entropy_difference(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """For every row of (doc_id, text): doc_id, n_tokens, h_target, h_background
    (mean losses in nats), score (h_target - h_background). The target are the
    documents whose doc_id is in ``chosen``; no word or pair is left out.

    Defined cases: a text without words, null included, has null losses and
    score, and so has every text if the target has no token; rows that repeat
    a doc_id, or have none, count and are scored on their own (all or none of
    one id's are in the target, a null id is not); nulls and repeats in
    ``chosen`` are ignored; a very long text is scored whole, its task holds
    its tokens; an empty table gives an empty result; other columns are
    ignored."""
    spark = df.sparkSession
    ship(spark)
    marks = Marks(documents(df, "doc_id", "text"), chosen)
    docs = marks.docs
    first = settle(_first_pass(docs, marks), "first")
    totals = {r["key"]: r["n"] for r in first.where(F.col("kind") == _TOTALS).collect()}
    total, total_target, texts, texts_target = (totals.get(k, 0) for k in range(4))
    if not total_target:
        return _unscored(docs)
    distinct = first.where(F.col("kind") == _DISTINCT).count()

    least = max((SHARE - 1 / KEPT) * total, 1)
    words, pairs = (
        np.sort(np.asarray(first.where((F.col("kind") == kind) & (F.col("n") >= least)).select("key").toArrow()["key"]).astype(np.int64).view(np.uint64)) for kind in (_WORDS, _PAIRS)
    )
    of_word, of_pair = _second_pass(docs, marks, words, pairs)
    known = of_pair[2] >= 0  # a frequent pair ends in a frequent word, but for words at the very edge of the share
    pairs, of_pair = pairs[known], of_pair[:, known]

    scale = total_target / total  # background counts at the target's size
    model = Model(words, np.zeros(0), np.zeros(0), pairs, np.zeros(0), scale, distinct + UNSEEN, total_target)
    chance = np.array(model.chances(of_word[1], of_word[0]))
    context = np.log(np.array([np.append(of_word[3], texts_target), np.append(of_word[2], texts) * scale]) + PAIR_PRIOR)
    pair_loss = -np.log(np.array([of_pair[1], of_pair[0] * scale]) + PAIR_PRIOR * chance[:, of_pair[2]])
    model = spark.sparkContext.broadcast(replace(model, chance=chance, context=context, pair_loss=pair_loss))

    rows = _pair_rows(docs, marks, model).repartition(max(1, -(-total // TASK_ROWS)), "key")
    sums = _scored(rows, model).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("target").alias("target"), F.sum("background").alias("background"))
    means = sums.select("doc_id", "n_tokens", *[F.expr(f"CASE WHEN n_tokens > 0 THEN {c} / n_tokens END").alias(f"h_{c}") for c in ("target", "background")])
    return means.withColumn("score", F.col("h_target") - F.col("h_background"))


def good_rows(labels: DataFrame) -> Column:
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, those labelled good and not toxic being the
    target; cases as in ``cross_entropy_difference``."""
    labels = table(spark, sf_dir, "labels")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), labels.where(good_rows(labels)).select("doc_id"))
