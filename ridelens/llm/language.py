"""Language identification with spans of mixed-language text.

Each word gets a score per language: the log likelihood of its letter n-grams
(1 to 3 letters, marked where a run of letters begins or ends) and of its whole
letter runs, under counts learned from labelled documents. The scripts of a
word's letters narrow the candidates: a language counts only if the script has
a share of that language's training letters, whatever other languages have. A Viterbi pass over each document's words,
with a penalty for switching, gives every word a language; runs of one language
are the spans, and the document's language is the one with the most letters.

Counting covers all training documents: tasks count into a hashed table of
fixed size, which Spark sums. The summed table (languages x buckets) is the
model, broadcast to the scoring pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm import words as W
from ridelens.llm.runtime import documents, ship, table

BUCKETS = 1 << 17
#: As many as fit a path's states (uint8).
MAX_LANGUAGES = 255
ORDERS = 3
SWITCH_PENALTY = 12.0
#: A script needs this share of a language's training letters for the language to be a candidate for it.
MIN_SCRIPT_SHARE = 0.002
SMOOTHING = 0.5
UNKNOWN = "und"
_GROUP_BYTES = 4 << 20

# First and last code point of the main blocks of each script (Unicode).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x139F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
_OTHER = len(SCRIPTS)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its lower case, its script."""
    top = 0x40000
    chars = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(top)]
    letter = np.fromiter((c.isalpha() for c in chars), bool, top)
    lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(chars)), np.uint32, top)
    script = np.full(top, _OTHER, np.uint8)
    for k, ranges in enumerate(SCRIPTS.values()):
        for lo, hi in ranges:
            script[lo : hi + 1] = k
    return letter, lower, script


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte each begins at. Points beyond
    the tables are held at the last one (no letter)."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    wide = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint32)
    lead = wide[at]
    point = lead.copy()
    for low, keep, n in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        own = np.flatnonzero(lead >= low)
        value = lead[own] & keep
        for j in range(1, n + 1):
            value = (value << 6) | (wide[at[own] + j] & 0x3F)
        point[own] = value
    return np.minimum(point, len(_tables()[0]) - 1), at


@dataclass
class Letters:
    """Letters of a slice: the word each is in, its script, and the features
    (bucket, word) of the words."""

    word: np.ndarray
    script: np.ndarray
    features: list[tuple[np.ndarray, np.ndarray]]


def read_letters(w: W.Words) -> Letters:
    letter, lower, script = _tables()
    points, at = code_points(w.data)
    word_of_byte = np.full(len(w.data) + 1, -1, np.int32)
    size = w.end - w.start
    inside = np.repeat(w.start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    word_of_byte[inside] = np.repeat(np.arange(len(size), dtype=np.int32), size)
    is_letter = letter[points]
    at, points = at[is_letter], points[is_letter]
    ordinal = np.flatnonzero(is_letter)
    word = word_of_byte[at]
    n = len(at)
    begins = np.ones(n, bool)
    begins[1:] = (np.diff(ordinal) != 1) | (word[1:] != word[:-1])
    ends = np.ones(n, bool)
    ends[:-1] = begins[1:]
    run = np.cumsum(begins)
    hashed = W.mix64(lower[points].astype(np.uint64) + np.uint64(1))
    features = []
    rolled = np.zeros(n, np.uint64)
    for order in range(1, ORDERS + 1):
        m = n - order + 1
        if m <= 0:
            break
        rolled = rolled[:m] * np.uint64(0xC6A4A7935BD1E995) + hashed[order - 1 :]
        whole = run[:m] == run[order - 1 :]
        marks = begins[:m].astype(np.uint64) + np.uint64(2) * ends[order - 1 :].astype(np.uint64)
        key = W.mix64(rolled + marks * W.salt(11) + W.salt(order))[whole]
        features.append(((key >> np.uint64(47)).astype(np.int32), word[:m][whole]))
    if n:
        first = np.flatnonzero(begins)
        place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        weight = W.mix64(place.astype(np.uint64)) | np.uint64(1)
        key = W.mix64(np.add.reduceat(hashed * weight, first) + W.salt(17))
        features.append(((key >> np.uint64(47)).astype(np.int32), word[first]))
    return Letters(word, script[points], features)


@dataclass
class Model:
    languages: list[str]
    #: Log likelihood by bucket and language.
    scores: np.ndarray
    #: By script and language: whether the language is a candidate.
    candidates: np.ndarray


def fit(languages: list[str], counts: np.ndarray, scripts: np.ndarray) -> Model:
    """From feature counts (languages x buckets) and letters (languages x scripts)."""
    scores = np.empty((counts.shape[1], len(languages)), np.float32)
    for k, own in enumerate(counts):  # a language at a time: copies of all would be large
        smooth = own + SMOOTHING
        scores[:, k] = np.log(smooth / smooth.sum())
    scores[counts.sum(axis=0) == 0] = 0  # a feature never seen says nothing
    total = scripts.sum(axis=0)
    candidates = (scripts >= MIN_SCRIPT_SHARE * scripts.sum(axis=1, keepdims=True)) & (scripts > 0)
    candidates[:, total == 0] = True  # a script never seen rules no language out
    return Model(languages, scores, candidates.T)


def word_scores(model: Model, w: W.Words, letters: Letters) -> np.ndarray:
    """Words x languages; words without letters score 0 for all. A language
    that no script of a word allows is put far below the others."""
    n, k = len(w.start), len(model.languages)
    out = np.zeros((n, k), np.float32)
    for bucket, word in letters.features:
        if len(bucket):
            first = W.group_starts(word)
            out[word[first]] += np.add.reduceat(model.scores[bucket], first, axis=0)
    out /= ORDERS + 1
    if len(letters.word):
        first = W.group_starts(letters.word)
        allowed = np.maximum.reduceat(model.candidates[letters.script], first, axis=0)
        none = ~allowed.any(axis=1)
        allowed[none] = True
        out[letters.word[first]] -= np.where(allowed, 0, 1e4).astype(np.float32)
    return out


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best language index of each word; ``first`` bounds the texts' runs of
    words. Among equal paths the one staying, then the smaller index, wins."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    size, begin = size[order], first[:-1][order]
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest), side="left")  # texts longer than t
    n, k = len(scores), scores.shape[1]
    out = np.zeros(n, np.uint8)
    if not longest:
        return out
    switched, source = np.zeros((n, k), bool), np.zeros(n, np.uint8)
    best = scores[begin[: live[0]]].astype(np.float64)
    for t in range(1, longest):
        m = int(live[t])
        at = begin[:m] + t
        value = best[:m]
        top = value.argmax(axis=1)
        jump = value[np.arange(m), top][:, None] - penalty
        better = jump > value
        switched[at], source[at] = better, top
        best[:m] = np.where(better, jump, value) + scores[at]
    state = best.argmax(axis=1).astype(np.uint8)
    for t in range(longest - 1, -1, -1):
        m = int(live[t])
        at = begin[:m] + t
        now = state[:m]
        out[at] = now
        if t:
            state[:m] = np.where(switched[at, now], source[at], now)
    return out


def _count(docs: DataFrame, languages: list[str]) -> DataFrame:
    """(lang, bucket, n): features by language; buckets from BUCKETS on count
    letters by script."""

    def run(batches: Iterator[pa.RecordBatch]):
        at = {x: i for i, x in enumerate(languages)}
        width = BUCKETS + _OTHER + 1
        total = np.zeros(len(languages) * width, np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                lang = np.array([at[x] for x in part.column("lang").to_pylist()], np.int64)
                w = W.cut_words(part.column("text"))
                letters = read_letters(w)
                lang_of_word = lang[w.doc]
                for bucket, word in letters.features:
                    total += np.bincount(lang_of_word[word] * width + bucket, minlength=len(total))
                total += np.bincount(lang_of_word[letters.word] * width + BUCKETS + letters.script, minlength=len(total))
        found = np.flatnonzero(total)
        for lo in range(0, len(found), 1 << 16):
            some = found[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some // width, pa.int32()), pa.array(some % width, pa.int32()), pa.array(total[some])], names=["lang", "bucket", "n"])

    return docs.mapInArrow(run, "lang int, bucket int, n bigint")


def train(df: DataFrame) -> Model | None:
    """Learns from every row of (text, lang) that has both. None without such rows."""
    ship(df.sparkSession)
    docs = documents(df, "text", "lang").where("text is not null and lang is not null")
    languages = sorted(r.lang for r in docs.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: group rare labels first")
    if not languages:
        return None
    sums = _count(docs, languages).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, bucket, n = (np.asarray(sums[c]) for c in ("lang", "bucket", "n"))
    counts = np.zeros((len(languages), BUCKETS + _OTHER + 1))
    counts[lang, bucket] = n
    return fit(languages, counts[:, :BUCKETS], counts[:, BUCKETS:])


def label(df: DataFrame, model: Model | None, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """For every row of (doc_id, text): doc_id, lang_pred, score (share of the
    letters in words of that language), spans (start and end word, end
    exclusive, language). Defined cases: a text without letters, null included,
    is ``und`` with score 0 and no spans, and so is every text without a model;
    equal shares go to the first language in code point order; rows that repeat
    a doc_id, or have none, are labelled on their own; a very long text is
    labelled whole, its task holds its words' scores; an empty table gives an
    empty result; other columns are ignored."""
    ship(df.sparkSession)
    docs = documents(df, "doc_id", "text")
    shared = df.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]):
        known = shared.value
        most = _GROUP_BYTES * 100 // max(100, len(known.languages) if known else 0)  # scores are words x languages
        for batch in batches:
            for group in W.slices(batch, "text", most):
                rows = group.num_rows
                names, score, spans = [UNKNOWN] * rows, np.zeros(rows), [[] for _ in range(rows)]
                if known:
                    # Letters take far more room than scores: read them a slice at a time.
                    parts, counts, letters_of = [], [], []
                    for part in W.slices(group, "text"):
                        w = W.cut_words(part.column("text"))
                        letters = read_letters(w)
                        parts.append(word_scores(known, w, letters))
                        counts.append(w.counts())
                        letters_of.append(np.bincount(letters.word, minlength=len(w.start)))
                    first = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
                    doc = np.repeat(np.arange(rows), np.diff(first))
                    path = viterbi(np.concatenate(parts), first, penalty)
                    k = len(known.languages)
                    n_letters = np.bincount(doc * k + path, weights=np.concatenate(letters_of), minlength=rows * k).reshape(rows, k)
                    total, top = n_letters.sum(axis=1), n_letters.argmax(axis=1)
                    score = n_letters.max(axis=1) / np.maximum(total, 1)
                    new = np.ones(len(path), bool)
                    new[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
                    begin = np.flatnonzero(new)
                    end = np.append(begin[1:], len(path))
                    for d, lo, hi in zip(doc[begin].tolist(), begin.tolist(), end.tolist(), strict=True):
                        if total[d]:
                            spans[d].append({"start": lo - int(first[d]), "end": hi - int(first[d]), "lang": known.languages[path[lo]]})
                    names = [known.languages[x] if t else UNKNOWN for x, t in zip(top, total, strict=True)]
                yield pa.RecordBatch.from_arrays([group.column("doc_id"), pa.array(names), pa.array(score, pa.float64()), pa.array(spans, span)], names=["doc_id", "lang_pred", "score", "spans"])

    return docs.mapInArrow(run, "doc_id bigint, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text leaves remainder 2 by 4. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those not held out; cases as in
    ``label``."""
    docs = documents(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    out = label(docs, train(docs.where(~held_out())))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
