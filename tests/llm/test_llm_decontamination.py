"""Fingerprint lookup and passages against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from llm_help import SF, docs_frame, words_of
from ridelens.llm import decontamination as D
from ridelens.llm import words as W


def index_of(texts):
    return D.build_index(pa.table({"item_id": list(range(len(texts))), "text": pa.array(texts, pa.string())}))


def test_classes_are_within_a_quarter():
    for n in range(1, 3000):
        assert D.size_class(n) <= n < D.size_class(n) * 1.25 + 1


def test_running_counts_give_the_fingerprint_of_each_window():
    w = W.cut_words(pa.array(["a b c d e f g a b c"]))
    hashes = w.hashes()
    for size in (1, 2, 3, 5, 10):
        got = D.window_fingerprints(D.running_ones(hashes, size), size)
        for i, value in enumerate(got.tolist()):
            ones = [sum(int(h) >> bit & 1 for h in hashes[i : i + size]) for bit in range(64)]
            assert value == sum(1 << bit for bit, n in enumerate(ones) if 2 * n > size)


def test_running_counts_agree_over_blocks_and_widths():
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 1500).astype(np.uint64)
    for size in (1, 9, 255):
        prints = [D.window_fingerprints(D.running_ones(hashes, longest), size).tolist() for longest in (255, 256, 70_000)]
        assert prints[0] == prints[1] == prints[2] and len(prints[0]) == 1500 - size + 1
    assert D.running_ones(hashes[:0], 5).shape == (1, 64)


def test_lookup_finds_all_within_the_radius():
    rng = np.random.default_rng(7)
    index = index_of([" ".join(f"w{rng.integers(1000)}" for _ in range(20)) for _ in range(30)])
    size = D.size_class(20)
    values = index.classes[size][0]
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) if n else 0 for n in rng.integers(0, 7, 4000)], np.uint64)
    prints = np.concatenate((values[rng.integers(0, len(values), 4000)] ^ flips, rng.integers(0, 1 << 63, 4000).astype(np.uint64)))
    found = {(a, b) for x, y in D.lookup(index, size, prints) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    near = np.bitwise_count(prints[:, None] ^ values[None, :]) <= D.RADIUS
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def brute(docs, items, percent=80):
    """Whether some item-sized span is similar enough, over all spans."""
    out = set()
    norm = lambda t: [x.encode().lower() for x in words_of(t)]
    weigh = lambda w: _weights(w)
    for item, text in items:
        own = norm(text)
        if not own:
            continue
        a = weigh(own)
        for doc, body in docs:
            w = norm(body)
            for i in range(-4, max(len(w) - 3, 1)):
                span = w[max(i, 0) : max(0, i + len(own))]
                b = weigh(span)
                shared = sum(min(v, b[k]) for k, v in a.items() if k in b)
                if shared and 100 * shared >= percent * (sum(a.values()) + sum(b.values()) - shared):
                    out.add((doc, item))
                    break
    return out


def _weights(w):
    n, out = min(5, len(w)), {}
    for i in range(len(w) - n + 1) if n else ():
        key = tuple(w[i : i + n])
        out[key] = out.get(key, 0) + sum(map(len, key))
    return out


def test_passages_match_brute_force(spark):
    rng = random.Random(11)
    word = lambda: f"{rng.choice('bcdfgh')}{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 8, 16, 30, 59])))) for i in range(12)] + [(50, None), (51, " ")]
    docs = []
    for i in range(60):
        body = [word() for _ in range(rng.randrange(80))]
        if i % 2:
            passage = words_of(items[rng.randrange(12)][1])
            if i % 3 == 0 and len(passage) > 8:  # an edit near an end, or in the middle
                passage[rng.choice([0, 1, len(passage) // 2, -1])] = "EDITED"
            if i % 5 == 0:
                passage = [x.upper() for x in passage]
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        docs.append((i, " ".join(body)))
    found = D.contaminated(docs_frame(spark, docs, extra=True), spark.createDataFrame(items, "item_id int, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 20


def test_two_and_more_edits_match_brute_force():
    rng = random.Random(5)
    word = lambda: f"{rng.choice('bcdfgh')}{rng.randrange(3000)}" + "x" * rng.choice([0, 0, 9])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 5, 15, 19, 24, 30, 31, 38, 48, 51, 59, 74, 118])]
    docs = []
    for i in range(400):
        passage = words_of(items[i % len(items)][1])
        match i % 5:
            case 0:  # marks glued to both ends
                passage[0], passage[-1] = '"' + passage[0], passage[-1] + '"'
            case 1:  # a word near each end
                passage[rng.randrange(3)] = passage[-1 - rng.randrange(3)] = "EDITED"
            case 2:  # anywhere
                for _ in range(rng.choice([2, 3, 4])):
                    passage[rng.randrange(len(passage))] = "EDITED"
            case 3:  # words more or fewer
                passage.insert(rng.randrange(len(passage)), "MORE")
                del passage[rng.randrange(len(passage))]
            case _:  # cut at the text's ends
                passage = passage[rng.randrange(4) :]
        before = [word() for _ in range(rng.randrange(30) if i % 5 < 4 else 0)]
        docs.append((i, " ".join([*before, *passage, *[word() for _ in range(rng.randrange(30))]])))
    w = W.cut_words(pa.array([t for _, t in docs]), lower=True)
    got = {(doc, item) for doc, item, *_ in D.matches(index_of([t for _, t in items]), w, 80)}
    want = brute(docs, items)
    assert got == want and len(want) > 150


def test_blocks_and_edges(spark):
    items = spark.createDataFrame([(1, "q w e r t y u i o p"), (1, "q w e r t y u i o p"), (None, "z x c v b n m k l j"), (3, "")], "item_id bigint, text string")
    docs = docs_frame(spark, [(1, "a q w e r t y u i o p b q w e r t y u i o p"), (1, "none"), (None, "z x c v b n m k l j"), (4, None), (5, "")])
    for block_bytes in (1 << 20, 8):
        got = sorted(((r.doc_id, r.item_id, r.start, r.n_words, r.similarity) for r in D.contaminated(docs, items, block_bytes=block_bytes).collect()), key=str)
        assert got == sorted([(1, 1, 1, 10, 1.0), (1, 1, 12, 10, 1.0), (None, None, 0, 10, 1.0)], key=str)
        kept = D.drop_contaminated(docs.withColumnRenamed("doc_id", "Contaminated"), items, block_bytes=block_bytes)
        assert kept.columns == ["Contaminated", "text"]
        assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([(1, "none"), (4, None), (5, "")], key=str)
    assert D.contaminated(docs.limit(0), items).count() == 0 and D.contaminated(docs, items.limit(0)).count() == 0


def test_whole_table_finds_every_verbatim_passage(spark):
    sf = SF.replace("0.001", "0.01")
    docs = {r.doc_id: " " + " ".join(words_of(r.text)).lower() + " " for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: " " + " ".join(words_of(r.text)).lower() + " " for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    verbatim = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in D.op7_decontamination(spark, sf).collect()}
    assert verbatim and verbatim <= got
    shares = lambda d, i: any(" ".join(words_of(items[i])[k : k + 5]) in docs[d] for k in range(len(words_of(items[i])) - 4))
    assert all(shares(d, i) for d, i in got)


def test_a_very_long_text_is_searched_whole(spark):
    passage = "q w e r t y u i o p"
    long = " ".join(f"w{i}" for i in range(700_000))
    docs = docs_frame(spark, [(1, f"{long} {passage}"), (2, f"{passage} {long} {passage}"), (3, long)])
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    assert sorted((r.doc_id, r.start) for r in D.contaminated(docs, items).collect()) == [(1, 700_000), (2, 0), (2, 700_010)]
    assert [r.doc_id for r in D.drop_contaminated(docs, items).select("doc_id").collect()] == [3]
