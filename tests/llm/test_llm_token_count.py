"""Counts against the libraries' own encoding of the same texts."""

from __future__ import annotations

import random

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from llm_help import SF, docs_frame
from ridelens.llm import pretokens as P
from ridelens.llm import token_count as T

BYTES = T.public_path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n\n \t x", "hello world's  end ", "don't WE'LL", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext |>",
    "naïve façade 東京 ١٢٣ ½", "՘࢏ x", "\U00010940\U0001F600 z", "  　 \x1c\x1d\x85 a", "�", "a" * 3000, "12345 678,90", "é" * 700, "x\x00y",
]


def library(path):
    if path.endswith(".json"):
        tok = Tokenizer.from_file(path)
        return lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)
    sp = SentencePieceProcessor(model_file=path)
    return lambda t: len(sp.encode(t or "", num_threads=1))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(spark, name):
    path = T.public_path(name)
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again"), (3, "again")]
    got = sorted(T.token_counts(docs_frame(spark, rows, extra=True), path, 3).collect(), key=str)
    count = library(path)
    want = [(i, len((t or "").encode()), count(t), count(t) > 3) for i, t in rows]
    assert got == sorted(want, key=str)


def test_an_empty_table_and_the_limit_itself(spark):
    assert T.token_counts(docs_frame(spark, []), BYTES).collect() == []
    (row,) = T.token_counts(docs_frame(spark, [(1, " a" * 512)]), BYTES).collect()
    assert row.n_tokens == 512 and not row.over_limit


def test_random_texts_over_all_kinds_of_characters(spark):
    rng = random.Random(5)
    kinds = [lambda: chr(rng.randrange(32, 127)), lambda: chr(rng.choice([9, 10, 13, 32, 32, 160, 0x2003])), lambda: chr(rng.randrange(0xA0, 0x600)), lambda: chr(rng.randrange(0x600, 0xD800)), lambda: chr(rng.randrange(0x10000, 0x20000)), lambda: rng.choice(["'s", "'ll", "the", " and"])]
    rows = [(i, "".join(rng.choice(kinds)() for _ in range(rng.randrange(60)))) for i in range(800)]
    count = library(BYTES)
    assert {r.doc_id: r.n_tokens for r in T.token_counts(docs_frame(spark, rows), BYTES).collect()} == {i: count(t) for i, t in rows}


def test_the_proof_holds_only_single_tokens():
    proof = P.read_tokenizer(BYTES)
    tok = Tokenizer.from_file(BYTES)
    assert len(proof.whole) > 40_000 and "<|endoftext|>" not in proof.whole
    some = random.Random(1).sample(sorted(proof.whole), 500)
    assert all(tok.encode(s, add_special_tokens=False).ids == [proof.whole[s]] for s in some)
    assert not proof.sure("՘") and proof.sure("東京 é")


def test_what_a_task_remembers_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 5)
    pieces, count = P.Pieces(P.read_tokenizer(BYTES)), library(BYTES)
    for t in ["qxzv wqzk zzqx vvwq", "kqxj zqvw jjqz qqqz zxzx"]:
        assert pieces.count(t) == count(t)
    assert len(pieces.known) <= len(pieces.proof.whole) + 5


def test_a_file_beyond_the_bound_is_refused(monkeypatch):
    monkeypatch.setattr(P, "MAX_FILE_BYTES", 10)
    with pytest.raises(ValueError, match="more than 10"):
        P.read_tokenizer(BYTES)


def test_a_very_long_text_is_counted_whole(spark):
    text = "Lorem ipsum dolors " * 300_000
    (row,) = T.token_counts(docs_frame(spark, [(1, text)]), BYTES).collect()
    assert (row.n_bytes, row.n_tokens) == (len(text), library(BYTES)(text))


def test_the_query_over_the_test_table(spark):
    import pyarrow.parquet as pq

    docs, count = pq.read_table(f"{SF}/documents.parquet").to_pylist(), library(BYTES)
    want = {d["doc_id"]: (len((d["text"] or "").encode()), count(d["text"])) for d in docs}
    got = T.op11_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(docs)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_many_chunks_at_once_have_the_ids_of_each():
    proof = P.read_tokenizer(BYTES)
    assert len(proof.ranks) == len(proof.rank_ids) == 50_256
    pieces, tok = P.Pieces(proof), Tokenizer.from_file(BYTES)
    tok.encode_special_tokens = True
    rng = random.Random(2)
    chunks = [" " + "".join(rng.choice("abcdeé,.'1東\0ü") for _ in range(rng.randrange(9))) for _ in range(3000)]
    chunks += [" ՘", "\n\nabc", "  two", " x ", " <|endoftext|>", "\tq", " \0", " a\0b", " " + "qz" * 4000, "\xa0nbsp"] + [" " + s for s in TEXTS if s]
    rng.shuffle(chunks)
    assert pieces.ids_of_each(chunks) == [tok.encode(c, add_special_tokens=False).ids for c in chunks]
    assert pieces.ids_of_each([]) == [] and pieces.ids_of_each([" "]) == [[220]]


@pytest.mark.parametrize("change", [lambda m: m["merges"].reverse(), lambda m: m["merges"].append(["Ġ", "the"]), lambda m: m["merges"].insert(0, m["merges"].pop(3000))])
def test_no_ranks_are_proven_where_merges_are_out_of_order(change):
    import json

    spec = json.loads(open(BYTES, encoding="utf-8").read())
    change(spec["model"])
    assert P.merge_ranks(Tokenizer.from_str(json.dumps(spec))) == ({}, ())
