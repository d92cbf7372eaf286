"""Alignment against brute force over the libraries' own tokens."""

from __future__ import annotations

import bisect
import collections
import hashlib
import operator
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from llm_help import SF, docs_frame
from ridelens.llm import alignment as A
from ridelens.llm.pretokens import token_bytes
from ridelens.llm.token_count import public_path

END = operator.itemgetter(2)
PATH_A, PATH_B = public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model")


def spans(parts):
    out, at = [], 0
    for number, raw in parts:
        out.append((number, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows):
    tok = Tokenizer.from_file(PATH_A)
    tok.encode_special_tokens = True
    names = {i: s for s, i in tok.get_vocab().items()}
    sp = SentencePieceProcessor(model_file=PATH_B)
    docs = []
    for doc, text in rows:
        groups, pairs, a, b = [], [], [], []
        if text:
            a = [(i, token_bytes(names[i])) for i in tok.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()) for i in sp.encode(text) for p in [sp.id_to_piece(i)]]
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a = b = []
        sa, sb = spans(a), spans(b)
        low = 0
        for end in sorted({e for *_, e in sa} & {e for *_, e in sb}):
            ga, gb = ([s for s in side[bisect.bisect_right(side, low, key=END) : bisect.bisect_right(side, end, key=END)]] for side in (sa, sb))
            groups.append(",".join(str(i) for i, *_ in ga) + "|" + ",".join(str(i) for i, *_ in gb))
            pairs += [(x[0], y[0]) for x in ga for y in gb if max(x[1], y[1]) < min(x[2], y[2])]
            low = end
        docs.append((doc, len(a), len(b), groups, pairs))
    count = collections.Counter(p for *_, pairs in docs for p in pairs)
    top = collections.defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [
        (doc, n_a, n_b, len(groups), len(pairs), sum(count[p] == top[p[1]] for p in pairs), sum(count[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc, n_a, n_b, groups, pairs in docs
    ]


def test_chunks_that_are_forgotten_are_aligned_again(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "bc ", "déf", "\n", "x\ty", "  ", "東京"]) for _ in range(30)) for _ in range(40)]
    monkeypatch.setattr(A, "REMEMBERED", 10)
    monkeypatch.setattr(A.W, "SLICE_BYTES", 64)
    chunks = A.Chunks(A.read_tokenizer(PATH_A), A.read_tokenizer(PATH_B))
    got = [chunks.align([t]) for t in texts]
    want = {r[0]: r for r in brute(list(enumerate(texts)))}
    assert [(*g[0][0].tolist(), g[1][0]) for g in got] == [(*want[i][1:5], want[i][7]) for i in range(len(texts))]
    assert len(chunks.place) < 40


def test_texts_are_cut_only_where_no_piece_goes_on():
    chunks = A.Chunks(A.read_tokenizer(PATH_A), A.read_tokenizer(PATH_B))
    assert chunks.b.cuts_before == " \n"  # its pieces go on over a carriage return
    assert chunks.of("two words\n ok;\r\nthat  is") == [" two", " words", "\n ok;\r\nthat", "  is"]
    assert A.chunk_pattern("\n") is None and A.chunk_pattern(" ").findall(" a\nb c") == [" a\nb", " c"]
    chunks._cut = None
    assert chunks.of("two words") == [" two words"] and chunks.of("") == chunks.of(None) == []


TEXTS = [
    None, "", " ", "  two  spaces ", "\n\ttabs\r\n", "a▁b", "Hello, world! It's naïve.", "<s> </s> <unk> <0x41> <|endoftext|>", "東京タワー 日本語", "\U0001F600 ok \U0001F468‍\U0001F469",
    "x\x00y", "ﬁ ½ ２", "՘࢏", "aaaaaaaaaaaaaaaaaaaaaaaa", ");\r\n{\r\r \r x;\r \n\n\ny", "\n\nx \n y\x0b \x0c\u3000 z", "1234567890 12 345", "Hello, world! It's naïve.", "е́ й ё", "café café", "﻿start", " nbsp",
]


@pytest.mark.parametrize("share", [A.PAIR_SHARE, 0.02, 2.0])
def test_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(A, "PAIR_SHARE", share)  # all pairs held, some, none
    rng = random.Random(3)
    made = ["".join(rng.choice("ab éü東 .\n12𝒳\r;\t") for _ in range(rng.randrange(80))) for _ in range(60)]
    rows = [*enumerate(TEXTS + made), (None, "no id at all"), (3, "again"), (3, "again")]
    out = A.align(docs_frame(spark, rows, extra=True), PATH_A, PATH_B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute(rows), key=str)


def test_an_empty_table(spark):
    assert A.align(docs_frame(spark, []), PATH_A, PATH_B).collect() == []


def test_links_of_slices_with_many_tokens_on_both_sides():
    rng = random.Random(9)
    for _ in range(300):
        size = rng.randrange(1, 40)
        ends = [np.array(sorted({size, *rng.sample(range(1, size + 1), rng.randrange(size))})) for _ in "ab"]
        got = A.links(*ends, *A.slices(*ends))
        starts = [np.concatenate(([0], e[:-1])) for e in ends]
        want = {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if max(starts[0][i], starts[1][j]) < min(ends[0][i], ends[1][j])}
        assert set(zip(*map(np.ndarray.tolist, got))) == want and len(got[0]) == len(want)


def test_a_very_long_text(spark):
    rows = [(1, "Lorem ipsum dolores " * 50_000), (2, "dolores")]
    got = {r.doc_id: r for r in A.align(docs_frame(spark, rows), PATH_A, PATH_B).collect()}
    once = A.align(docs_frame(spark, [(1, "Lorem ipsum dolores " * 50)]), PATH_A, PATH_B).first()
    assert abs(got[1].n_groups - 1000 * once.n_groups) < 2000 and got[2].n_links > 0


def test_the_query_over_the_test_table(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    got = sorted(map(tuple, A.op13_alignment(spark, SF).collect()), key=str)
    assert got == sorted(brute([(d["doc_id"], d["text"]) for d in docs]), key=str)
