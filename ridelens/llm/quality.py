"""Quality verdicts: fixed rules on counts, then a calibrated classifier.

The classifier is a logistic regression over hashed words, word pairs and
three-byte character n-grams, each kind as its share of the text, so that text
length alone moves nothing. It is fitted on a bounded sample of labelled rows
(``TRAIN_ROWS``, the smallest hashes of doc_id), four fifths for the weights
and the rest for calibrating its output to a probability (Platt scaling). All
documents are scored in Arrow batches with the broadcast weights (a table of
fixed size) against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.runtime import carry, documents, ship, table

TRAIN_ROWS = 3000
BUCKETS = 1 << 18
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 50, 50, 0.5
EPOCHS, RATE, DECAY = 80, 2.0, 1e-6

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (W.mix64(hashes + W.salt(kind)) >> np.uint64(46)).astype(np.int32)


def _features(w: W.Words, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every occurrence, one kind of feature at a time."""
    yield _buckets(hashes, 1), w.doc
    pairs, whole = W.window_hashes(hashes, w.doc, 2)
    yield _buckets(pairs[whole], 2), w.doc[: len(pairs)][whole]
    data = w.data.astype(np.uint64)
    if len(data) > 2:
        grams = data[:-2] | (data[1:-1] << np.uint64(8)) | (data[2:] << np.uint64(16))
        owner = np.repeat(np.arange(len(w.offsets) - 1), np.diff(w.offsets))
        whole = owner[:-2] == owner[2:]
        yield _buckets(grams[whole], 3), owner[:-2][whole]


def _logits(w: W.Words, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    n = len(w.offsets) - 1
    total = np.zeros(n)
    for bucket, owner in _features(w, hashes):
        size = np.bincount(owner, minlength=n)
        total += np.bincount(owner, weights=weights[bucket], minlength=n) / np.maximum(size, 1)
    return total


def _counts(w: W.Words, hashes: np.ndarray, texts: pa.Array) -> list[pa.Array]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n = len(w.offsets) - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[w.offsets[1:]] - total[w.offsets[:-1]]

    chars = W.inside_words(w.data) & ((w.data & 0xC0) != 0x80)
    rolled, whole = W.window_hashes(hashes, w.doc, 3)
    keys = W.mix64(rolled + w.doc[: len(rolled)].astype(np.uint64) * W.salt(5))[whole]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    covered = np.zeros(len(hashes), bool)
    at = np.flatnonzero(whole)[np.isin(keys, twice)]
    for j in range(3):
        covered[at + j] = True
    dup_lines = []
    for text in texts.cast(pa.large_binary()).to_pylist():
        lines = [x for x in (text or b"").split(b"\n") if x.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    repeat = np.bincount(w.doc[covered], minlength=n)
    return [pa.array(x, pa.int64()) for x in (w.counts(), per_text(chars), per_text(_SYMBOL[w.data]), dup_lines, repeat)]


def _training_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, quality, bucket, share): the sparse features of each row."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.cut_words(part.column("text"))
                buckets, shares = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
                for bucket, owner in _features(w, w.hashes()):
                    size = np.maximum(np.bincount(owner, minlength=part.num_rows), 1)
                    key, count = np.unique(owner.astype(np.int64) * BUCKETS + bucket, return_counts=True)
                    cut = np.searchsorted(key, np.arange(part.num_rows + 1) * BUCKETS)
                    for d in range(part.num_rows):
                        buckets[d].append(key[cut[d] : cut[d + 1]] - d * BUCKETS)
                        shares[d].append(count[cut[d] : cut[d + 1]] / size[d])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("quality"),
                        pa.array([np.concatenate(x).astype(np.int32) for x in buckets], pa.list_(pa.int32())),
                        pa.array([np.concatenate(x).astype(np.float32) for x in shares], pa.list_(pa.float32())),
                    ],
                    names=["doc_id", "quality", "bucket", "share"],
                )

    return docs.mapInArrow(run, "doc_id bigint, quality int, bucket array<int>, share array<float>")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _platt(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities (Newton's method)."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(slope * scores + shift)
        err, spread = p - target, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(err * scores).sum(), err.sum()])
        hess = np.array([[(spread * scores**2).sum(), (spread * scores).sum()], [(spread * scores).sum(), spread.sum()]]) + np.eye(2) * 1e-3
        step = np.linalg.solve(hess, grad)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(shift)


def fit(rows: pa.Table) -> tuple[np.ndarray, float, float] | None:
    """Weights, slope and shift from sparse rows; None unless both labels occur
    among the rows for the weights."""
    order = np.argsort(np.asarray(rows["doc_id"]), kind="stable")
    last = np.arange(len(order)) % 5 == 4  # the fifth for calibration, moved to the end
    rows = rows.take(pa.array(np.concatenate((order[~last], order[last])))).combine_chunks()
    label = np.asarray(rows["quality"]).astype(np.float32)
    n = int((~last).sum())
    if len(label) < 10 or len(np.unique(label[:n])) < 2:
        return None
    sizes = np.asarray(rows["bucket"].chunk(0).value_lengths())
    begin = np.concatenate(([0], np.cumsum(sizes)))
    bucket = np.asarray(rows["bucket"].chunk(0).flatten()).astype(np.intp)
    share = np.asarray(rows["share"].chunk(0).flatten())
    del rows
    used = slice(0, int(begin[n]))
    weights, seen, bias = np.zeros(BUCKETS, np.float32), np.full(BUCKETS, 1e-8, np.float32), 0.0

    def logits(lo: int, hi: int) -> np.ndarray:
        part = slice(int(begin[lo]), int(begin[hi]))
        total = np.concatenate(([0.0], np.cumsum(weights[bucket[part]] * share[part], dtype=np.float64)))
        return total[begin[lo + 1 : hi + 1] - begin[lo]] - total[begin[lo:hi] - begin[lo]]

    for _ in range(EPOCHS):
        err = ((_sigmoid(logits(0, n) + bias) - label[:n]) / n).astype(np.float32)
        grad = np.bincount(bucket[used], weights=np.repeat(err, sizes[:n]) * share[used], minlength=BUCKETS).astype(np.float32) + DECAY * weights
        seen += grad**2
        weights -= RATE * grad / np.sqrt(seen)
        bias -= 0.5 * float(err.sum())
    lo, hi = (n, len(label)) if len(np.unique(label[n:])) == 2 else (0, n)
    return weights, *_platt(logits(lo, hi), label[lo:hi].astype(np.float64))


def train(df: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float, float] | None:
    """Fits on at most ``rows`` documents (doc_id, text) with a label (doc_id,
    quality 0/1). Rows with a null id or label, or another label, are passed
    over; a doc_id labelled both ways counts as 0; of rows that repeat a doc_id
    one (the smallest text) is used."""
    ship(df.sparkSession)
    docs = documents(df, "doc_id", "text")
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marks.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = _training_rows(sample).toArrow()
    return fit(found) if found.num_rows else None


_VERDICT = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, p_quality double, kept boolean"


def judge(df: DataFrame, model: tuple[np.ndarray, float, float] | None) -> tuple[DataFrame, list[str]]:
    """``df`` (doc_id, text and any other columns) with counts and verdict of
    every row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, p_quality, kept; and these columns' names, which are lengthened
    where ``df`` has them. Defined cases: a null or blank text has zero counts
    and fails; without a model (no labels, or of one kind only) p_quality is
    null and the rules decide alone; rows that repeat a doc_id, or have none,
    are judged on their own; a probability at the threshold passes; a very long
    text is judged whole, its task holds its words; an empty table gives an empty
    result."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        fitted = shared.value
        for part in W.slices(batch, "text"):
            w = W.cut_words(part.column("text"))
            hashes = w.hashes()
            counts = _counts(w, hashes, part.column("text"))
            n_words, n_repeat = (np.asarray(counts[i]) for i in (0, 4))
            failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
            p = np.ones(part.num_rows)
            if fitted:
                p = _sigmoid(fitted[1] * _logits(w, hashes, fitted[0]) + fitted[2])
            yield part, [*counts, pa.array(failed), pa.array(p, mask=np.full(len(p), not fitted)), pa.array(~failed & (p >= MIN_PROBABILITY))]

    return carry(df, run, _VERDICT)


def quality_rules(df: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Fits on the labelled documents and judges all: doc_id and the columns of
    ``judge``. See there and in ``train`` for the defined cases."""
    docs = documents(df, "doc_id", "text")
    judged, _ = judge(docs, train(docs, labels, rows))
    return judged.drop("text")


def keep_good(df: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``df`` that pass, all columns as they were: null, blank and
    short texts go, of rows that repeat a doc_id each is judged by its own text;
    the other cases are those of ``judge``."""
    judged, names = judge(df, train(df, labels, rows))
    return judged.where(F.col(names[-1])).select(*[F.col(f"`{c}`") for c in df.columns])


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents judged by the rules and the labelled rows' classifier; cases
    as in ``judge``."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
