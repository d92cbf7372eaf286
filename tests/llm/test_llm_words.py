"""Word cutting and hashing against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelens.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\r\x0b\x0cabAéß语🙂 ", max_size=40)), max_size=8)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    w = W.cut_words(pa.array(texts, pa.string()))
    found = [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end)]
    for d, text in enumerate(texts):
        assert found[w.first[d] : w.first[d + 1]] == words_of(text)
        assert (w.doc[w.first[d] : w.first[d + 1]] == d).all()


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_window_hashes_are_equal_for_equal_words_only(texts, length):
    w = W.cut_words(pa.array(texts, pa.string()))
    rolled, whole = W.window_hashes(w.hashes(), w.doc, length)
    flat = [x for t in texts for x in words_of(t)]
    by_hash, by_words = {}, {}
    for i in np.flatnonzero(whole).tolist():
        key = tuple(flat[i : i + length])
        assert by_hash.setdefault(int(rolled[i]), key) == key
        assert by_words.setdefault(key, int(rolled[i])) == int(rolled[i])
    assert int(whole.sum()) == sum(max(0, len(words_of(t)) - length + 1) for t in texts)


def test_a_sliced_column_gives_the_same_words():
    column = pa.array(["a b", None, "", "c  d e", "f"])
    part = W.cut_words(column.slice(1, 3))
    assert part.counts().tolist() == [0, 0, 3]
    assert W.cut_words(pa.array(["c  d e"])).hashes().tolist() == part.hashes().tolist()


def test_lower_case_folds_ascii_only():
    a, b = (W.cut_words(pa.array([t]), lower=True).hashes().tolist() for t in ("ABZ", "abz"))
    assert a == b
    assert W.cut_words(pa.array(["É"]), lower=True).hashes().tolist() != W.cut_words(pa.array(["é"])).hashes().tolist()


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 100, 3, 3, 3)]})
    parts = list(W.slices(batch, "text", most=10))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()
    assert len(parts) > 1
