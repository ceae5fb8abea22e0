"""The operators that run on DataFrame functions only, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from acreline.llm import chat, linededup, sharding

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(WHITE).translate(LOW)


def docs_for_lines(seed):
    rng = random.Random(seed)
    lines = ["", " ", "Aé B", "aé b\t", "AÉ b", "x", "X ", "Ãé", "ãé", "long " * 9, " q", "q", "Ðð", "K", "k", "ẞß", "…"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.choice([1, 2, 5, 12])))) for i in range(40)]
    return docs + [(50, None), (51, ""), (52, "only here\nx"), (53, "\n\n"), (None, "x\ny")]


@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup_is_brute_force(spark, keep_first):
    for seed in (1, 2):
        docs = docs_for_lines(seed)
        where = defaultdict(set)
        for d, t in docs:
            for x in (t or "").split("\n"):
                where[key(x)].add(d)
        often = {k for k, v in where.items() if k and len(v) >= 10}
        seen, want = set(), {}
        for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
            kept = []
            for x in (t or "").split("\n"):
                if key(x) in often and not (keep_first and key(x) not in seen):
                    continue
                seen |= {key(x)} & often
                kept.append(x)
            want[d] = ((t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(kept), "\n".join(kept))
        df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("start", "drop", "_d", "_t", "_x", "_lines", "_runs", "_kept", "row", "_may")})
        got = {r["doc_id"]: (r["_n_lines"], r["_n_dropped"], r["_kept"]) for r in linededup.dedup_lines(df, 10, keep_first).collect()}
        assert got == want


def test_rows_of_one_id_are_one_document(spark):
    rows = [(i, "a") for i in range(8)] + [(8, "a"), (8, "a\nb")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["_n_dropped"] for r in linededup.dedup_lines(df).collect()} == {0}
    more = spark.createDataFrame([*rows, (None, "a\nc")], "doc_id long, text string")
    assert sorted(r["_n_dropped"] for r in linededup.dedup_lines(more).collect()) == [1] * 11
    other = spark.createDataFrame([(None, f"a\n{i}") for i in range(10)], "doc_id long, text string")
    assert {r["_kept"] for r in linededup.dedup_lines(other).collect()} == {str(i) for i in range(10)}


def test_kept_first_lines_leave_columns_as_they_were(spark):
    rows = [(i, "shared\nown " + str(i), 3, "r") for i in range(12)] + [(20, "shared", 6, "r"), (None, None, None, None), (21, "", 0, None), (22, "shared\n" * 200_000 + "end", 5, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, drop string")
    got = {r["doc_id"]: tuple(r)[1:] for r in linededup.keep_first_lines(df).collect()}
    assert linededup.keep_first_lines(df).schema == df.schema
    want = {0: ("shared\nown 0", 3, "r"), **{i: (f"own {i}", len(f"own {i}"), "r") for i in range(1, 12)}, None: (None, None, None), 21: ("", 0, None), 22: ("end", 3, "r")}
    assert got == want


def test_repeated_rows_are_one_document(spark):
    df = spark.createDataFrame([(1, "a\nb")] * 12 + [(2, "a")], "doc_id long, text string")
    assert {(r["doc_id"], r["_n_dropped"]) for r in linededup.dedup_lines(df).collect()} == {(1, 0), (2, 0)}
    assert linededup.dedup_lines(df.where("false")).collect() == []


def shards_of(spark, docs, n=5):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("size", F.lit("clash"))
    rows = sharding.assign(df, n).collect()
    assert len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(0 <= s < n for s in slots)
    texts = Counter((d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for d, t in docs)
    assert texts == Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in rows)
    size = Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
    return rows, size


def test_shards_have_nearly_equal_bytes(spark):
    rng = random.Random(5)
    docs = [(i, "é" * int(rng.expovariate(1 / 80))) for i in range(600)] + [(1000 + i, "copy " * 20) for i in range(400)] + [(None, None), (5000, ""), (5000, "")]
    rows, size = shards_of(spark, docs)
    mean = sum(size.values()) / 5
    most = max(r["size"] for r in rows)
    assert all(abs(s - mean) <= most + 0.03 * mean for s in size.values())


def test_shards_of_few_rows(spark):
    shards_of(spark, [(1, "a"), (2, "b")])
    shards_of(spark, [(1, "same")] * 7)
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_written_shards_hold_all(spark, tmp_path):
    df = spark.createDataFrame([(i, "t" * i) for i in range(50)], "doc_id long, text string")
    sharding.write_shards(df, str(tmp_path / "out"), 4)
    want = {r["doc_id"]: r["shard"] for r in sharding.assign(df, 4).collect()}
    assert {r["doc_id"]: r["shard"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want
    more = df.withColumns({"shard": F.lit("mine"), "_h": F.lit("h"), "_i": F.lit(None).cast("string")}).union(spark.createDataFrame([(None, None, "x", None, "i"), (3, "t" * 10**6, "x", "h", "i")], "doc_id long, text string, shard string, _h string, _i string"))
    assert sharding.write_shards(more, str(tmp_path / "more"), 4) == "shard_"
    read = spark.read.parquet(str(tmp_path / "more")).select(*more.columns)
    assert sorted(map(str, read.collect())) == sorted(map(str, more.collect()))


def conversations(seed):
    rng = random.Random(seed)
    bits = ["</s>[INST] ok [/INST]", "<|end|>", "\\", "<", "<|turn|>", "\\|", "<\\|", "é\n", "word ", "<|text|>", "🙂"]
    rows = []
    for conv in range(25):
        for turn in range(rng.choice([1, 2, 8, 40])):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", "<|end|>", None])
            rows.append((conv, turn, role, rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.choice([1, 5, 60])))])))
    return rows + [(None, 0, "assistant", "x"), (90, None, "user", "u"), (90, 1, "assistant", "y"), (90, 1, "assistant", "y"), (91, 0, "system", "s")]


@pytest.mark.parametrize(("budget", "history", "hot"), [(120, 40, 10**6), (700, 200, 30), (90, 20, 0)])
def test_chat_reads_back(spark, budget, history, hot):
    rows = conversations(4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash"))
    made = chat.windows(df, budget=budget, history=history, hot_rows=hot)
    got = {r["conv_id"]: r for r in chat.digest(made).collect()}
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        conv[c].append((turn is not None, turn or 0, role or "", text or ""))
    chars = Counter()
    for r in made.collect():
        chars[r["conv_id"]] += len(r["formatted"])
        for s in r["loss"]:
            assert r["formatted"][s["start"] + s["n"] :].startswith("<|end|>")
    assert set(got) == set(conv)
    for c, turns in conv.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, _, a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == chars[c]


def brute_windows(turns, budget, history):
    """Windows by a plain walk over (turn, role, text) in order: lists of (again, role, text)."""
    esc = lambda t: t.replace("\\", "\\\\").replace("<|", "<\\|")
    size = lambda t: len(esc(t[1]).encode()) + len(esc(t[2]).encode()) + 24
    lead, total = 0, 0
    while lead < len(turns) and turns[lead][1] == "system" and total + size(turns[lead]) <= (budget - history) // 2:
        total += size(turns[lead])
        lead += 1
    room, span, at, made = max(1, budget - history - total), chat.CELL * budget, 0, []
    place = []
    for i, t in enumerate(turns[lead:], lead):
        if not made or at // span != cell or fill + size(t) > room:
            made.append([])
            place.append((at, i))
            cell, fill = at // span, 0
        made[-1].append((False, *t[1:]))
        fill += size(t)
        at += size(t)
    out = []
    for (begin, i), own in zip(place, made, strict=True):
        back, used = [], 0
        for t in reversed(turns[lead:i]):
            used += size(t)
            if used > history:
                break
            back.insert(0, (True, *t[1:]))
        out.append([(bool(out), *t[1:]) for t in turns[:lead]] + back + own)
    return out or [[(False, *t[1:]) for t in turns]]


@pytest.mark.parametrize("hot", [10**6, 20])
def test_chat_windows_are_brute_force(spark, hot):
    rng = random.Random(9)
    rows = [(c, i, "system" if i < c % 3 else rng.choice(["user", "assistant"]), "w" * rng.choice([0, 5, 30, 200])) for c in range(8) for i in range(rng.choice([1, 3, 60, 200]))]
    rows += [(50, i, "system", "s" * 30) for i in range(40)] + [(51, 0, "user", "x" * 9000), (51, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.windows(df, budget=300, history=100, hot_rows=hot).select("conv_id", "window", chat.read_turns(F.col("formatted")).alias("t"))
    got = defaultdict(list)
    for r in made.orderBy("conv_id", "window").collect():
        got[r["conv_id"]].append([(t["again"], t["role"], t["text"]) for t in r["t"]])
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        conv[c].append((turn, role, text))
    assert dict(got) == {c: brute_windows(sorted(t), 300, 100) for c, t in conv.items()}


def test_chat_takes_counts_of_a_tokenizer(spark):
    df = spark.createDataFrame([(1, i, "user", "word " * 50, 10) for i in range(20)], "conv_id long, turn long, role string, text string, n long")
    assert chat.windows(df, budget=50, history=0, tokens=F.col("n")).count() == 4


def test_long_conversations_and_turns(spark):
    rows = spark.range(20_000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('t', 400) as text")
    rows = rows.union(spark.range(1).selectExpr("2L", "id", "'assistant'", "repeat('long <| ', 1000000)"))
    got = {r["conv_id"]: r for r in chat.digest(chat.windows(rows)).collect()}
    assert (got[1]["n_turns"], got[1]["loss_chars"]) == (20_000, 4_000_000)
    assert (got[2]["n_turns"], got[2]["loss_chars"]) == (1, 8_000_000)


def test_chat_windows_keep_to_the_budget(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, i, "user" if i % 2 else "assistant", "w" * 40) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.windows(df, budget=400, history=150).select("window", chat.read_turns(F.col("formatted")).alias("t")).orderBy("window").collect()
    assert len(made) > 3
    own = []
    for w in made:
        assert w["t"][0]["role"] == "system" and w["t"][0]["again"] == (w["window"] > 0)
        assert sum(24 + len((t["text"] + t["role"]).encode()) for t in w["t"]) <= 400
        assert w["window"] == 0 or any(t["again"] and t["role"] != "system" for t in w["t"])
        own += [t["text"] for t in w["t"] if not t["again"]]
    assert len(own) == 60
    assert chat.digest(chat.windows(df.where("false"))).collect() == []
