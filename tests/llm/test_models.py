"""Nearest neighbours, token counts, quality, URL filters and the pipeline."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreline.llm import ann, quality, tokencounts, urlfilter
from acreline.llm.tokens import WordTokens, default_path

SF = "/root/testdata/sf0.001"


def exact(rows, asked, k=5):
    fine = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in fine.items()}
    out = {}
    for q in asked:
        if q in unit:
            out[q] = sorted((-float(unit[q] @ u), i) for i, u in unit.items() if i != q)[:k]
    return out


def test_nearest_reaches_the_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 20))
    rows = [(i, [float(x) for x in centres[i % 30] + rng.normal(size=20)]) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"vec": F.lit("clash"), "leaf": F.lit(1)})
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact(rows, range(0, 6000, 50))
    assert set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:], strict=False))


def test_lone_vectors_get_all_their_neighbours(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 24))
    rows = [(i, [float(x) for x in centres[i % 5] + 0.01 * rng.normal(size=24)]) for i in range(9000)]
    for i in range(12):  # far from all clusters and from each other
        rows[50 * i] = (50 * i, [float(x) for x in 9 * rng.normal(size=24)])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(got) == 180 and {len(v) for v in got.values()} == {5}
    want = exact(rows, range(0, 9000, 50))
    assert sum(len(set(got[q]) & {i for _, i in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_vectors_of_other_lengths_have_neighbours_of_their_own(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8 if i % 3 else 5 if i % 9 else 2)]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {}
    for n in (2, 5, 8):
        want |= exact([r for r in rows if len(r[1]) == n], [r[0] for r in rows if len(r[1]) == n and r[0] % 5 == 0])
    for block in (4096, 50):
        monkeypatch.setattr(ann, "BLOCK_ROWS", block)
        monkeypatch.setattr(ann, "QUERY_ROWS", block)
        got = {}
        for r in ann.nearest(df, df.where("vec_id % 5 = 0")).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["vec_id"])
        hits = sum(len(set(got[q]) & {i for _, i in want[q]}) for q in want)
        assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))


def test_nearest_with_odd_vectors_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [0.5, 0.5])]
    rows += [(50, None), (51, []), (52, [0.0, 0.0]), (53, [nan, 1.0]), (54, [inf, 1.0]), (55, [None, 1.0]), (56, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (100, [1e300, 1e300]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = [0, 7, 50, 56, 100]
    got = {}
    for r in ann.nearest(df, spark.createDataFrame([(a,) for a in asked], "vec_id long")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert [v for _, v, _ in sorted(got[0])] == [1, 2, 3, 4, 5]
    assert [v for _, v, _ in sorted(got[7])] == [0, 1, 2, 3, 4]
    assert [v for _, v, _ in sorted(got[100])] == [8, 0, 1, 2, 3]
    assert set(got) == {0, 7, 100}  # 56 has no other vector of its length
    few = spark.createDataFrame(rows[:1] + rows[8:9], "vec_id long, embedding array<double>")
    assert [(r["query_id"], r["vec_id"]) for r in ann.nearest(few, few.where("vec_id = 0")).collect()] == [(0, 8)]
    assert ann.nearest(df.where("false"), df).collect() == []


def test_rollup_is_idempotent(spark, tmp_path):
    rollup = tokencounts.Rollup(spark, f"file://{tmp_path}/r")
    kind = "kind string, source string, lang string, tokenizer string, tokens long, old_tokens long"
    assert rollup.totals().collect() == []
    one = spark.createDataFrame([("insert", "a", "en", "t", 5, None), ("insert", "a", "en", "t", 7, None), ("insert", None, "en", "t", None, None)], kind)
    assert rollup.apply("1", one) and not rollup.apply("1", one)
    two = spark.createDataFrame([("delete", "a", "en", "t", None, 5), ("revise", "a", "en", "t", 9, 7), ("insert", "b", None, "u", 2, None)], kind)
    assert rollup.apply("2", two)
    want = {("a", "en", "t", 1, 9), (None, "en", "t", 1, 0), ("b", None, "u", 1, 2)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == want
    assert not rollup.apply("2", two)
    assert rollup.apply("3", two.where("false"))
    assert rollup.apply("4", spark.createDataFrame([("delete", "b", None, "u", None, 2)], kind))
    assert {tuple(r) for r in rollup.totals().collect()} == want - {("b", None, "u", 1, 2)}
    with pytest.raises(Exception, match="unknown kind"):
        rollup.apply("5", spark.createDataFrame([("upsert", "b", None, "u", None, 2)], kind))
    assert not rollup.committed("5")


KIND = "kind string, source string, lang string, tokenizer string, tokens long, old_tokens long"


def totals(rollup):
    return {tuple(r) for r in rollup.totals().collect()}


def test_a_batch_that_failed_is_written_again(spark, tmp_path):
    rollup = tokencounts.Rollup(spark, f"file://{tmp_path}/r")
    rows = spark.createDataFrame([("insert", "a", "en", "t", 5, None)], KIND)
    rollup._commit, commit = lambda state: 1 / 0, rollup._commit
    with pytest.raises(ZeroDivisionError):  # sums are written, the manifest is not
        rollup.apply("1", rows)
    rollup._commit = commit
    (tmp_path / "r" / "aside").mkdir()
    (tmp_path / "r" / "aside" / "half").write_text('{"generation": 1, "li')
    assert totals(rollup) == set()
    assert rollup.apply("1", rows)
    assert totals(rollup) == {("a", "en", "t", 1, 5)}
    assert rollup.vacuum() == 1
    assert totals(rollup) == {("a", "en", "t", 1, 5)}


def test_writers_at_the_same_time(spark, tmp_path):
    """Two compactions and two senders of one batch meet at every commit; each batch counts once."""
    one, two = (tokencounts.Rollup(spark, f"file://{tmp_path}/r") for _ in range(2))
    batch = lambda n: spark.createDataFrame([("insert", "a", "en", "t", n, None)], KIND).withColumn("n_docs", F.lit("clash"))
    assert one.apply("1", batch(5)) and one.apply("2", batch(3))
    commit = one._commit

    def late(state):
        one._commit = commit
        assert two.compact() and two.apply("3", batch(5)) and not two.apply("3", batch(5))
        return commit(state)

    one._commit = late
    assert not one.compact()
    assert totals(one) == {("a", "en", "t", 3, 13)}

    def beaten(state):
        one._commit = commit
        assert two.apply("4", batch(1))
        return commit(state)

    one._commit = beaten
    assert not one.apply("4", batch(1))

    def joined(state):
        one._commit = commit
        assert two.apply("5", batch(2))
        return commit(state)

    one._commit = joined
    assert one.compact()  # folds what it has read; batch 5 stays beside it
    assert totals(one) == {("a", "en", "t", 5, 16)}


def test_op2_totals_are_a_recount(spark):
    from acreline.llm.queries import op2_token_counts

    tokens, want = WordTokens(default_path()), {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = want.setdefault((r["source"], r["lang"]), [0, 0])
        n[0] += 1
        n[1] += len(tokens.whole(r["text"] or ""))
    assert {(r["source"], r["lang"]): [r["n_docs"], r["n_tokens"]] for r in op2_token_counts(spark, SF).collect()} == want


def test_token_counts_equal_the_library(spark):
    docs = spark.createDataFrame([(1, "Hello, world's 12", "en", "a"), (2, None, None, "a"), (3, "", "en", None), (1, "x", "en", "a")], "doc_id long, text string, lang string, source string")
    tokens = WordTokens(default_path())
    got = sorted((r["doc_id"], r["tokens"]) for r in tokencounts.count_tokens(docs).collect())
    assert got == sorted((r["doc_id"], len(tokens.whole(r["text"] or ""))) for r in docs.collect())


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF[:-3]}01/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    judged = [(got[r["doc_id"]], r["quality"]) for r in labels.collect() if r["doc_id"] in got]
    out = [(r["predicted"], q) for r, q in judged if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert len(out) > 50 and sum(p == q for p, q in out) >= 0.95 * len(out)
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}
    assert kept == {d for d, r in got.items() if r["predicted"]}


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "x" * 10**6), (3, "é")], "doc_id long, text string").withColumn("x", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    assert {r["score"] for r in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality.classify(docs.where("false"), labels).collect() == []


def test_registered_domains(spark):
    hosts = ["a.b.example.com", "example.co.uk", "www.example.co.uk:8080", "me@x.example.org.", "co.uk", "uk", "", "10.0.0.1:80", "[::1]:443", "b.co.com", "x.io"]
    got = {r["host"]: (r["domain"], r["suffix"]) for r in urlfilter.with_parents(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()}
    assert got == {
        "a.b.example.com": ("example.com", "com"), "example.co.uk": ("example.co.uk", "co.uk"), "www.example.co.uk:8080": ("example.co.uk", "co.uk"), "me@x.example.org.": ("example.org", "org"),
        "co.uk": ("co.uk", "co.uk"), "uk": ("uk", "uk"), "": ("", ""), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]:443": ("[::1]", "[::1]"), "b.co.com": ("co.com", "com"), "x.io": ("x.io", "io"),
    }


def brute_rule(host, path):
    best = None
    for verdict, h, p in urlfilter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (verdict, h + p)
    return best


def test_url_rules_and_reputation(spark):
    rng = random.Random(1)
    urls = ["http://A.example.COM/en/7?x", "https://example.com/en/8", "x://com/en/", "http://b.net/de/8", "http://m.example.net/de/8#q", "nothing", None, "://", "http://org?/es/", "http://É.org/es/a", "http://nexample.com/en/7", "a://b://c.com/en/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(100 + i, f"http://bad.example.com/fr/{i}") for i in range(200)] + [(400 + i, f"http://good.example.com/fr/{i}") for i in range(200)] + [(None, "http://new.example.com/"), (100, "http://bad.example.com/again")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = [(100 + i, int(rng.random() < 0.95)) for i in range(200)] + [(400 + i, int(rng.random() < 0.05)) for i in range(200)] + [(5, None), (None, 1)]
    outcomes = spark.createDataFrame(labels, "page_id long, bad int")
    got = urlfilter.judge(pages, outcomes).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, urlfilter.judge(pages, outcomes, broadcast_hosts=0).collect())) == sorted(map(str, got))
    for r in got:
        rule = brute_rule(r["host"], r["path"])
        assert r["rule"] == (rule[1] if rule else None)
        if rule:
            assert r["verdict"] == rule[0]
        elif r["host"].startswith("bad."):
            assert r["verdict"] == "block"
        elif r["host"].startswith(("good.", "new.")):
            assert r["verdict"] == "allow"
    by_url = {r["page_id"]: (r["host"], r["path"]) for r in got}
    assert by_url[0] == ("a.example.com", "/en/7") and by_url[5] == ("", "") and by_url[8] == ("org", "") and by_url[9][0] == "É.org".replace("O", "o")
    assert by_url[11] == ("b:", "//c.com/en/")
    assert {r["verdict"] for r in urlfilter.judge(pages, outcomes.where("false")).collect() if r["rule"] is None} == {"allow"}
    assert urlfilter.judge(pages.where("false"), outcomes).collect() == []


def test_trees_are_walked_as_they_are_grown():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    x[:, 4] = np.round(x[:, 4])  # ties
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0) | (x[:, 4] == 1)).astype(float)
    model = quality.fit(x, y)

    def walk(row):
        total = model.base
        for feature, cut, value in zip(model.feature, model.cut, model.value, strict=True):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += value[node]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(model.score(x), [walk(r) for r in x], atol=1e-12)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(120, 3)), 1).astype(np.float32)
    y = (x[:, 1] + 0.3 * rng.normal(size=120) > 0.2).astype(float)
    model = quality.fit(x, y)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = y - p, np.full(len(y), p * (1 - p))
    best = (-1.0, None)
    for f in range(3):
        cuts = np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1]).astype(np.float32))
        for c in cuts:
            left = x[:, f] <= c
            if min(left.sum(), (~left).sum()) >= quality.LEAST:
                gain = sum(g[m].sum() ** 2 / (h[m].sum() + quality.RIDGE) for m in (left, ~left)) - g.sum() ** 2 / (h.sum() + quality.RIDGE)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, float(c)))
    assert (int(model.feature[0][0]), float(model.cut[0][0])) == best[1]


def test_features_of_a_long_text_are_those_of_its_bytes(monkeypatch):
    import pyarrow as pa
    from acreline.llm import textkit

    texts = ["Aab  b\n1!é" * 50, "", "x" * 300, "end"]
    whole = [quality.features(d, o) for _, _, d, o in textkit.text_slices(pa.array(texts))]
    monkeypatch.setattr(textkit, "SLICE_BYTES", 64)
    monkeypatch.setattr(textkit, "_powers", {})
    parts = np.concatenate([quality.features(d, o) for _, _, d, o in textkit.text_slices(pa.array(texts))])
    assert np.array_equal(np.concatenate(whole), parts)
    h = [textkit.words(d, o, True) for _, _, d, o in textkit.text_slices(pa.array(texts))]
    monkeypatch.undo()
    w = [textkit.words(d, o, True) for _, _, d, o in textkit.text_slices(pa.array(texts))]
    assert np.array_equal(np.concatenate([x.h for x in h]), np.concatenate([x.h for x in w])) and np.array_equal(np.concatenate([x.h2 for x in h]), np.concatenate([x.h2 for x in w]))


def test_stages_take_odd_rows(spark):
    """Nulls, empty and very long texts, repeats and clashing columns through every stage but the packing."""
    import corpus_pipeline as p

    long = " ".join(f"word{i % 5003} and" for i in range(150_000))
    rows = [(1, None, "r"), (2, "", "r"), (None, "no id here at all", "r"), (None, None, None), (3, long, "r"), (3, long, "r"), (4, long + " end", "r"), (5, "a b c", "r"), (5, "x y z", "r"), (6, "\n\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "length(text) as n_chars", "1 as drop", "2 as _may", "'k' as kept", "3 as rep", "4 as uid", "5 as component")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    from acreline.llm.quality import keep_good

    assert sorted(map(str, keep_good(docs, labels, threshold=0.5).collect())) == sorted(map(str, docs.collect()))
    assert keep_good(docs, labels, threshold=0.6).collect() == []
    for name, stage in p.STAGES[1:-1]:
        made = stage(spark, docs, SF)
        assert made.schema == docs.schema, name
        got = sorted(((r["doc_id"], r["text"]) for r in made.collect()), key=str)
        want = [(d, t) for d, t, _ in rows]
        if name == "n-gram Jaccard join":
            want = [w for w in dict.fromkeys(want) if w[0] != 4] + [w for w in want if w[0] is None and want.count(w) > 1]
        assert got == sorted(want, key=str), name
        assert stage(spark, docs.where("false"), SF).collect() == []
    packed = p.packing(spark, docs, SF)
    tokens = WordTokens(default_path())
    assert packed.agg(F.sum("length")).first()[0] == sum(len(tokens.whole(t or "")) + 1 for _, t, _ in rows)
    assert p.packing(spark, docs.where("false"), SF).collect() == []


def test_pipeline_stages_are_brute_force(spark):
    import corpus_pipeline as p
    from test_decontaminate import brute as brute_hits
    from test_native import key
    from test_nearjoin import brute as brute_classes

    docs = p.stored(p.quality_classifier(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), "good")
    text = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before = text(docs)
    where = {}
    for d, t in before.items():
        for x in {key(x) for x in (t or "").split("\n")} - {""}:
            where.setdefault(x, []).append(d)
    want = {}
    for d in sorted(before):
        lines, seen = (before[d] or "").split("\n"), set()
        kept = []
        for x in lines:
            if len(where.get(key(x), [])) >= 10 and (min(where[key(x)]) != d or key(x) in seen):
                continue
            seen.add(key(x))
            kept.append(x)
        if kept:
            want[d] = "\n".join(kept)
    deduped = p.stored(p.line_dedup(spark, docs, SF), "lines")
    assert text(deduped) == want
    classes = brute_classes(list(want.items()))
    want = {d: t for d, t in want.items() if classes[d][0] == d}
    single = p.stored(p.ngram_jaccard_join(spark, deduped, SF), "single")
    assert text(single) == want
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = {r[0]: r[2] for r in brute_hits(list(want.items()), items)}
    assert text(p.benchmark_decontamination(spark, single, SF)) == {d: t for d, t in want.items() if not hits[d]}


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in p.STAGES[:-1]:
        after = p.stored(stage(spark, docs, SF), "test")
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert {r["doc_id"] for r in rows} <= seen
        docs, seen = after, {r["doc_id"] for r in rows}
    assert 0 < len(seen)
    tokens = WordTokens(default_path())
    packed = p.packing(spark, docs, SF).collect()
    lengths = {}
    for r in packed:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {r["doc_id"]: len(tokens.whole(r["text"] or "")) + 1 for r in docs.collect()}
    again = p.run(spark, SF)
    assert sorted(map(tuple, again.select("doc_id", "start", "length").collect())) == sorted((r["doc_id"], r["start"], r["length"]) for r in packed)
