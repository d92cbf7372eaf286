"""Viterbi against all paths, spans of mixed texts, held-out accuracy."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_help import SF, docs_frame
from ridelens.llm import language as L
from ridelens.llm import words as W


def best_by_all_paths(scores, penalty):
    n, k = scores.shape
    return max(sum(scores[t, s] for t, s in enumerate(p)) - penalty * sum(a != b for a, b in itertools.pairwise(p)) for p in itertools.product(range(k), repeat=n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=4), st.integers(0, 10_000), st.sampled_from([0.0, 0.7, 5.0]))
def test_viterbi_finds_the_best_path_of_each_text(sizes, seed, penalty):
    rng = np.random.default_rng(seed)
    first = np.concatenate(([0], np.cumsum(sizes)))
    scores = rng.normal(size=(first[-1], 3)).astype(np.float32)
    path = L.viterbi(scores, first, penalty)
    for a, b in itertools.pairwise(first):
        if b > a:
            own = path[a:b]
            value = sum(scores[a + t, s] for t, s in enumerate(own)) - penalty * sum(x != y for x, y in itertools.pairwise(own.tolist()))
            assert abs(value - best_by_all_paths(scores[a:b], penalty)) < 1e-4


def test_code_points_of_utf8():
    text = "aé語🙂 Ωж"
    data, _ = W.text_buffer(pa.array([text]))
    points, at = L.code_points(data)
    assert [min(ord(c), 0x3FFFF) for c in text] == points.tolist()
    assert at.tolist() == [len(text[:i].encode()) for i in range(len(text))]


EN = "the house and the garden were in the old part of the town with a river"
DE = "das haus und der garten waren in dem alten teil der stadt mit einem fluss"
RU = "дом и сад были в старой части города у реки"


def trained(spark):
    rows = [(f"{EN} {i}", "en") for i in range(8)] + [(f"{DE} {i}", "de") for i in range(8)] + [(RU, "ru")] * 4 + [(None, "en"), ("x", None)]
    return L.train(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_of_a_mixed_text(spark):
    model = trained(spark)
    text = f"{EN} {DE} {RU}"
    n_en, n_de, n_ru = (len(x.split()) for x in (EN, DE, RU))
    rows = [(1, text), (2, None), (3, ""), (4, "12 ?? --"), (5, RU), (5, RU), (None, DE), (6, "漢字")]
    got = {}
    for r in L.label(docs_frame(spark, rows, extra=True), model).collect():
        got.setdefault(r.doc_id, []).append(r)
    spans = [(s.start, s.end, s.lang) for s in got[1][0].spans]
    assert spans == [(0, n_en, "en"), (n_en, n_en + n_de, "de"), (n_en + n_de, n_en + n_de + n_ru, "ru")]
    for d in (2, 3, 4):
        assert (got[d][0].lang_pred, got[d][0].score, got[d][0].spans) == ("und", 0.0, [])
    assert [r.lang_pred for r in got[5]] == ["ru", "ru"] and got[None][0].lang_pred == "de"
    assert got[6][0].lang_pred == "de"  # a script never seen: all are equal, the first is named
    assert 0 < got[1][0].score < 1 and got[5][0].score == 1


def test_scripts_narrow_the_candidates(spark):
    model = trained(spark)
    at = {k: i for i, k in enumerate(L.SCRIPTS)}
    allowed = {k: [x for x, ok in zip(model.languages, model.candidates[at[k]], strict=True) if ok] for k in ("latin", "cyrillic", "han")}
    assert allowed == {"latin": ["de", "en"], "cyrillic": ["ru"], "han": ["de", "en", "ru"]}


def test_a_small_language_is_a_candidate_beside_a_large_one(spark):
    """One language has 99.9 % of the Latin letters, the other 0.1 %."""
    rows = [(EN, "en")] * 2000 + [(DE, "de")] * 2 + [(RU, "ru")]
    model = L.train(spark.createDataFrame(rows, "text string, lang string"))
    got = {r.doc_id: r for r in L.label(docs_frame(spark, [(1, DE), (2, EN), (3, f"{EN} {DE}"), (4, RU)]), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 4)] == ["de", "en", "ru"]
    assert [s.lang for s in got[3].spans] == ["en", "de"]


def test_as_many_labels_as_the_states_allow(spark):
    """A language a letter, up to the 255th, which is learned and predicted too."""
    rows = [(chr(0x4E00 + i) * 3, f"l{i:03}") for i in range(255)]
    model = L.train(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.languages) == 255
    got = {r.doc_id: r.lang_pred for r in L.label(docs_frame(spark, [(i, t) for i, (t, _) in enumerate(rows)]), model).collect()}
    assert got == {i: lang for i, (_, lang) in enumerate(rows)}
    with pytest.raises(ValueError, match="255"):
        L.train(spark.createDataFrame([*rows, ("x", "one more")], "text string, lang string"))


def test_no_labels_gives_und(spark):
    assert L.train(spark.createDataFrame([("x", None)], "text string, lang string")) is None
    out = L.label(docs_frame(spark, [(1, "some text")]), None).first()
    assert (out.lang_pred, out.score, out.spans) == ("und", 0.0, [])
    assert L.label(docs_frame(spark, []), None).count() == 0


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").collect()}
    got = L.op1_language_id(spark, SF.replace("0.001", "0.01")).collect()
    assert {r.doc_id for r in got} == set(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert len(held) > 200 and np.mean(held) > 0.98


def test_equal_shares_and_a_very_long_text(spark):
    model = trained(spark)
    tie = L.label(docs_frame(spark, [(1, "12 34")]), model).first()
    assert (tie.lang_pred, tie.score) == ("und", 0.0)
    rows = [(1, f"{EN} " * 60_000), (2, DE), (3, f"{RU} " * 20_000 + f"{EN} " * 30)]
    got = {r.doc_id: r for r in L.label(docs_frame(spark, rows), model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[3].lang_pred) == ("en", "de", "ru")
    assert sum(s.end - s.start for s in got[1].spans) == 60_000 * len(EN.split())
    assert [s.lang for s in got[3].spans] == ["ru", "en"]
