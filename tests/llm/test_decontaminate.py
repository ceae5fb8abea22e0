import random
import re

from acreline.llm.decontaminate import drop_contaminated, find_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items):
    words = lambda t: WORD.findall((t or "").translate(LOW))
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, t in items:
            v = words(t)
            n = min(10, len(v))
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    ids.add("null" if item_id is None else str(item_id))
        out.append((doc_id, len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=str)


def make(seed):
    rng = random.Random(seed)
    w = lambda n, k: [rng.choice("abcdefgh"[:k]) + rng.choice(["", "é", "X"]) for _ in range(n)]
    items = [(i, " ".join(w(rng.choice([0, 1, 3, 9, 10, 11, 30]), 8))) for i in range(12)] + [(None, None), (3, "Q q q q q q q q q q q q")]
    docs = []
    for i in range(60):
        parts = w(rng.choice([0, 4, 20, 60]), 3)
        if rng.random() < 0.6:
            v = rng.choice(items)[1] or ""
            v = v.split()
            a = rng.randrange(len(v) + 1)
            parts[len(parts) // 2 : len(parts) // 2] = v[a : a + rng.choice([5, 9, 10, 40])]
        docs.append((i, ", ".join(parts).upper() if i % 3 else ". ".join(parts)))
    return docs + [(100, None), (101, ""), (101, "..."), (None, "Q q q q q q q q q q q q q"), (102, "q " * 500)], items


def rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    for seed in range(3):
        docs, items = make(seed)
        d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as items", "1 as item_id")
        b = spark.createDataFrame(items, "item_id long, text string")
        assert rows(find_contamination(d, b)) == brute(docs, items)


def test_a_large_benchmark_gives_the_same(spark):
    docs, items = make(7)
    docs += [(200, "q " * 12), (200, "z " * 12), (200, "q " * 12), (None, "z " * 14)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert rows(find_contamination(d, b, broadcast_windows=0)) == brute(docs, items)


def test_dropping_keeps_the_clean_rows_as_they_were(spark):
    docs, items = make(5)
    docs += [(300, None), (None, None), (None, ""), (301, "q " * 12), (301, "clean words")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as row", "1 as uid", "true as _may", "2 as n")
    b = spark.createDataFrame(items, "item_id long, text string")
    clean = [(r[0], t) for r, (_, t) in zip([x for doc in docs for x in brute([doc], items)], docs, strict=True) if not r[2]]
    for limit in (0, 10**6):
        kept = drop_contaminated(d, b, limit)
        assert kept.schema == d.schema
        assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(clean, key=str)
    assert drop_contaminated(d, b.where("false")).count() == len(docs)
    assert drop_contaminated(d.where("false"), b).collect() == []


def test_a_long_text_is_worked_on_in_blocks(spark, monkeypatch):
    import pyarrow as pa
    from acreline.llm import decontaminate, textkit

    text = " ".join(f"w{i % 977}" for i in range(3000))
    w = [textkit.words(data, offsets, True) for _, _, data, offsets in textkit.text_slices(pa.array([text, "a b"]))][0]
    whole = decontaminate.prints(w, [2, 10], False)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    assert sorted(decontaminate.prints(w, [2, 10], False).tolist()) == sorted(whole.tolist())
    assert len(whole) == 2999 + 1 + 2991


def test_spans_are_the_hit_text(spark):
    d = spark.createDataFrame([(1, "Zé! A b c d e f g h i J, zz")], "doc_id long, text string")
    b = spark.createDataFrame([(5, "a b c d e f g h i j")], "item_id long, text string")
    r = find_contamination(d, b).first()
    s = r["spans"][0]
    assert "Zé! A b c d e f g h i J, zz".encode()[s["start"] : s["end"]] == b"A b c d e f g h i J"


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert rows(find_contamination(d, b)) == [(1, 2, 0, ())]
    assert rows(find_contamination(d.where("false"), b)) == []
