import random

from acreline.llm.nearjoin import choose_bands, jaccard_join, keep_one
from tests_support import WORD, LOW


def brute(docs, threshold=0.8):
    sets = {}
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    links = {d: {e for e in ids if e != d and sets[d] and sets[e] and len(sets[d] & sets[e]) >= threshold * len(sets[d] | sets[e]) - 1e-9} for d in ids}
    out = {}
    for d in ids:
        seen, todo = {d}, [d]
        while todo:
            for e in links[todo.pop()] - seen:
                seen.add(e)
                todo.append(e)
        out[d] = (min(seen), len(links[d]))
    return out


def make(seed, groups=12, size=12):
    rng = random.Random(seed)
    docs = []
    for g in range(groups):
        base = [rng.choice("abcdefghij") + rng.choice("klmnopq") + str(rng.randrange(40)) for _ in range(rng.choice([3, 5, 40, 120]))]
        for _ in range(rng.randrange(1, size)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = "edit" + str(rng.randrange(10**6))
            docs.append((rng.randrange(10**9), (" " if rng.random() < 0.5 else ", ").join(w)))
    return docs + [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two")]


def test_equals_brute_force(spark):
    docs = make(1)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as rep", "1 as block")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join(df).collect()}
    assert got == brute(docs)


def test_small_blocks_give_the_same(spark):
    docs = make(2, groups=3, size=60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join(df, block_bytes=20000).collect()}
    assert got == brute(docs)


def test_null_ids_repeats_and_empty(spark):
    t = "a b c d e f g h"
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, t), (3, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join(df).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 1, 1), (None, None, 0), (2, 1, 1), (3, 3, 0)], key=str)
    assert jaccard_join(df.where("false")).collect() == []


def test_bands_reach_the_recall():
    for t in (0.5, 0.8, 0.9):
        b, r = choose_bands(t, 0.999)
        assert 1 - (1 - t**r) ** b >= 0.999 and b * r <= 160


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    df = spark.createDataFrame([(1, None), (1, a), (1, b), (1, b), (2, a), (3, b), (4, "x")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join(df).collect()))
    assert got == [(1, 1, 0), (1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 4, 0)]
    kept = sorted(((r["doc_id"], r["text"]) for r in keep_one(df).collect()), key=str)
    assert kept == [(1, a), (1, b), (1, None), (4, "x")]
    # the same beside near copies, which are compared by text
    long = [f"w{i}" for i in range(60)]
    near = [" ".join(long), " ".join([*long[:-1], "end"])]
    df = spark.createDataFrame([(7, near[0]), (7, "0 1 2 3 4 5"), (8, near[1]), (9, near[0])], "doc_id long, text string")
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join(df).collect()) == [(7, 7, 0), (7, 7, 2), (8, 7, 2), (9, 7, 2)]
    assert sorted((r["doc_id"], r["text"]) for r in keep_one(df).collect()) == [(7, "0 1 2 3 4 5"), (7, near[0])]


def test_a_comparison_of_many_near_copies_needs_little_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from acreline.llm import nearjoin

    n = 3000
    texts = [" ".join([*(f"w{k}" for k in range(i % 60)), f"e{i}", *(f"w{k}" for k in range(i % 60 + 1, 60))]) for i in range(n)]
    made = pa.table({"side": pa.array([0] * n, pa.int32()), "rep": np.arange(n)[::-1].copy(), "copies": np.ones(n, dtype=np.int64), "text": texts})
    tracemalloc.start()
    got = nearjoin._compare(made, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == n and set(got["to"].to_pylist()) == {0}
    # two of them share more than 4/5 of 56 shingles if they differ at one place or close to an end
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for t in texts[:60]]
    kind = [[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    alike = [[len({s for s in a if not any(w[0] == "e" for w in s)} & b) for b in sets] for a in sets]
    for i in range(60):
        same = alike[i][i]
        own = n // 60 - 1 if same >= 0.8 * (2 * 56 - same) else 0
        others = sum(n // 60 for j in range(60) if j != i and kind[i][j])
        assert got["links"].to_pylist()[n - 1 - i] == own + others
    assert peak < 80e6
