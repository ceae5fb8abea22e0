import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from acreline.llm import packing
from acreline.llm.tokens import WordTokens, default_path


@pytest.fixture(scope="module")
def tokens():
    return WordTokens(default_path(), limit=50)


ODD = [
    "", "a b'ss don't  I'LL <|endoftext|> x<|endoftext|>y <|EndOfText|>", "İstanbul ΑΣ Σ. ß ẞ é \x85x\xa0y　z​q", "12½ ½. ²3 ². 'sx it's's.",
    "É é!!? ...", "\x1c a\x1fb.\x1f.", "ªº µ Å. ” ”.  “a”. …! a…!", "''s 's, ,'s ;'t dogs'. dogs',", "🙂🙂 ok. 🙂.", "12. 3, ١. ١ a<b>.", None,
]


def same(tokens, texts):
    got = {}
    for at, ids, bounds in tokens.encode(pa.array(texts, pa.string())):
        for r in range(len(bounds) - 1):
            got[at + r] = ids[bounds[r] : bounds[r + 1]].tolist()
    assert [got[i] for i in range(len(texts))] == [tokens.whole(t or "").tolist() for t in texts]


def test_ids_equal_the_library(tokens):
    same(tokens, ODD)
    same(tokens, ODD[::-1] * 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aBcé́É'.,!<|>\n 　\x1c½1”…s", max_size=30), max_size=6))
def test_ids_equal_the_library_on_random_texts(texts):
    from acreline.llm.tokens import word_tokens

    same(word_tokens(default_path()), texts)


def test_best_fit_is_the_sequential_algorithm():
    rng = np.random.default_rng(3)
    for window in (16, 50):
        lengths = sorted((int(x) for x in rng.integers(1, window + 1, 300)), reverse=True)
        open_windows, total = [], 0
        for n in lengths:
            fits = [i for i, r in enumerate(open_windows) if r >= n]
            if fits:
                open_windows[min(fits, key=lambda i: open_windows[i])] -= n
            else:
                open_windows.append(window - n)
        histogram = {n: lengths.count(n) for n in set(lengths)}
        runs = packing.best_fit_decreasing(histogram, window)
        fill = defaultdict(list)
        for length, first, last, seq, per, offset in runs:
            for i in range(last - first):
                fill[seq + i // per].append((offset + i % per * length, length))
            total += last - first
        assert total == len(lengths)
        for spans in fill.values():
            spans.sort()
            assert spans[0][0] == 0 and sum(spans[-1]) <= window
            assert all(sum(a) == b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert sorted(window - sum(max(s)) for s in fill.values()) == sorted(open_windows)


def test_pack_covers_every_id_once(spark, tokens):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, "word " * 60), (4, "word " * 60), (None, "x y"), (5, "z " * 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", packing.F.lit("clash"))
    got = packing.pack(docs, window=16).collect()
    sequences, copies = defaultdict(list), defaultdict(list)
    for r in got:
        assert 0 < r["length"] <= 16
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        copies[r["doc_id"]].append(r)
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(spans[-1]) <= 16
        assert all(sum(a) == b[0] for a, b in zip(spans, spans[1:], strict=False))
    for doc_id, text in rows:
        ids = np.append(tokens.whole(text or ""), np.uint32(1)).astype("<u4")
        pieces = {(r["start"], r["length"], r["ids_crc32"]) for r in copies[doc_id]}
        at = 0
        for start, length, crc in sorted(pieces):
            assert start == at and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids) == copies[doc_id][0]["doc_tokens"]
    assert len(copies[4]) == 8


def test_sequences_hold_the_ids(spark, tokens):
    docs = spark.createDataFrame([(i, "word é " * n) for i, n in enumerate([1, 5, 9, 30, 2])] + [(None, "null " * 20), (None, None), (None, None), (7, "same id " * 9), (7, "other " * 20)], "doc_id long, text string")
    packed = packing.pack(docs, window=16)
    made = {r["sequence_id"]: r for r in packing.sequences(docs, packed, window=16).collect()}
    want, got = [], []
    for r in docs.collect():
        ids = np.append(tokens.whole(r["text"] or ""), np.uint32(1)).tolist()
        want += [(r["doc_id"], a, ids[a : a + 16]) for a in range(0, len(ids), 16)]
    for p in packed.collect():
        got.append((p["doc_id"], p["start"], made[p["sequence_id"]]["ids"][p["offset"] : p["offset"] + p["length"]]))
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in made.values():
        n = r["n_tokens"]
        assert len(r["ids"]) == (n if n & (n - 1) == 0 else 16)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
