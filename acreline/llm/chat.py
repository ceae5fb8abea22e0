"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens, by window functions over the turns in order, place
every turn on one axis. The axis is cut into cells of CELL budgets; the turns
of a cell are cut into turn-aligned spans in one scan: a turn that would
exceed the budget opens the next window, and a cell does too. Every window
starts with the system turns that open the conversation (as far as they take
half of what history leaves of the budget) and repeats limited history, which
reaches into the cell before. The loss mask covers the texts of assistant
turns in the one window that owns them; turns that are repeated are marked
``again`` and masked.

    <|turn|>role<|text|>text<|end|>      a window's own turn
    <|again|>role<|text|>text<|end|>     a repeated one

Inside role and text ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no
text can hold a control string and ``unescape`` gives every text back.

A task holds a cell's turns at most, never a conversation's. Prefix sums of a
conversation are a sorted run over its rows in one task; conversations of more
than HOT_ROWS rows (the 1000 largest) are dealt to range partitions first,
whose sums are carried over, so they spread over tasks. The result is the same.

Turns go by ``turn`` (nulls first), then role and text; a null role or text is empty; rows
with a null ``conv_id`` are one conversation; repeated rows are kept. A turn
longer than the budget has a window of its own. Other columns are ignored and
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreline.runtime import stored

#: Tokens of a window and of the history that it repeats, at most.
BUDGET = 8192
HISTORY = 1024
#: Budgets that one cell holds.
CELL = 16
HOT_ROWS = 100_000

TURN, AGAIN, TEXT, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def turn_tokens(role: Column, text: Column) -> Column:
    """The UTF-8 bytes of a formatted turn: no byte-level vocabulary makes more tokens of it."""
    return (F.octet_length(escape(text)) + F.octet_length(escape(role)) + len(AGAIN + TEXT + END)).cast("long")


_ORDER = ("turn", "role", "text")


def _system() -> Column:
    return (F.col("role") == "system").cast("int")


def _numbered(rows: DataFrame, lead_limit: int) -> DataFrame:
    """Adds ``_i``, ``_sum`` (tokens up to and with the turn), ``_on`` (1 in the lead), ``_lead`` and ``_all`` tokens of the conversation."""
    conv = Window.partitionBy("conv_id")
    so_far = conv.orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = rows.withColumns({"_i": F.count("*").over(so_far), "_sum": F.sum("n").over(so_far), "_on": F.min(_system()).over(so_far)})
    got = got.withColumn("_on", F.col("_on") * (F.col("_sum") <= lead_limit).cast("int"))
    return got.withColumns({"_lead": F.max(F.col("_sum") * F.col("_on")).over(conv), "_all": F.sum("n").over(conv)})


def _numbered_in_parts(rows: DataFrame, lead_limit: int) -> DataFrame:
    """The same for few, large conversations: sums per range partition, carried from one to the next."""
    parts = stored(rows.repartitionByRange("conv_id", *_ORDER).withColumn("_part", F.spark_partition_id()), "turns")
    so_far = Window.partitionBy("_part", "conv_id").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = parts.withColumns({"_i": F.count("*").over(so_far), "_sum": F.sum("n").over(so_far), "_on": F.min(_system()).over(so_far)})
    sums = parts.groupBy("conv_id", "_part").agg(F.count("*").alias("_k"), F.sum("n").alias("_n"), F.min(_system()).alias("_s"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "_part", *(F.coalesce(f(c).over(before), F.lit(none)).alias(c + "0") for f, c, none in ((F.sum, "_k", 0), (F.sum, "_n", 0), (F.min, "_s", 1))), F.sum("_n").over(Window.partitionBy("conv_id")).alias("_all"))

    def met(left: DataFrame, right: DataFrame, *also: str) -> DataFrame:
        # a row per partition and one more per conversation, of which there are 1000 at most
        named = right.withColumnsRenamed({c: f"_r{c}" for c in ("conv_id", *also)})
        same = F.col("conv_id").eqNullSafe(F.col("_rconv_id"))
        for c in also:
            same &= F.col(c) == F.col(f"_r{c}")
        return left.join(F.broadcast(named), same).drop("_rconv_id", *(f"_r{c}" for c in also))

    got = met(got, carried, "_part").withColumns({"_i": F.col("_i") + F.col("_k0"), "_sum": F.col("_sum") + F.col("_n0"), "_on": F.least("_on", "_s0")})
    got = got.withColumn("_on", F.col("_on") * (F.col("_sum") <= lead_limit).cast("int")).drop("_part", "_k0", "_n0", "_s0")
    return met(got, got.groupBy("conv_id").agg(F.max(F.col("_sum") * F.col("_on")).alias("_lead"))).select("conv_id", *_ORDER, "n", "_i", "_sum", "_on", "_lead", "_all")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``conv_id, window, formatted, loss array<struct<start, n>>``.

    ``loss`` has the code points of ``formatted`` that are trained on.
    Windows ascend within a conversation, with gaps. ``tokens`` are the counts
    of some tokenizer for whole formatted turns; ``turn_tokens`` without.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    size = turn_tokens(role, text) if tokens is None else F.greatest(F.coalesce(tokens.cast("long"), F.lit(1)), F.lit(1))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), size.alias("n"))
    lead_limit, span = (budget - history) // 2, CELL * budget
    large = rows.groupBy("conv_id").count().where(F.col("count") > hot_rows).orderBy(F.desc("count")).limit(1000).select("conv_id")
    found = large.collect()
    placed = rows
    if found:
        hot = F.broadcast(rows.sparkSession.createDataFrame(found, large.schema).withColumnRenamed("conv_id", "_hot"))
        same = F.col("conv_id").eqNullSafe(F.col("_hot"))
        placed = rows.join(hot, same, "left_anti")
    placed = _numbered(placed, lead_limit)
    if found:
        placed = placed.unionByName(_numbered_in_parts(rows.join(hot, same, "left_semi"), lead_limit))

    # a turn goes to its cell, to the next one if its history can reach there, and the lead to all
    div = lambda x, y: F.floor(x / F.lit(y)).cast("long")
    at = F.col("_sum") - F.col("n") - F.col("_lead")
    placed = placed.withColumns({"_p": at, "_own": div(at, span)})
    last = div(F.greatest(F.col("_all") - F.col("_lead") - 1, F.lit(0)), span)
    cells = F.when(F.col("_on") == 1, F.sequence(F.lit(0).cast("long"), last)).otherwise(F.sequence("_own", div(F.col("_p") + history, span)))
    dealt = placed.withColumn("_cell", F.explode(cells))
    kind = F.when(F.col("_on") == 1, 0).when(F.col("_cell") == F.col("_own"), 2).otherwise(1)
    turn = F.struct("_i", kind.alias("kind"), F.col("_p").alias("p"), "n", "role", "text")
    cell = dealt.groupBy("conv_id", "_cell").agg(F.array_sort(F.collect_list(turn)).alias("_t"))
    only = lambda k: F.filter("_t", lambda t: t["kind"] == k)
    cell = cell.select("conv_id", "_cell", only(0).alias("_front"), only(1).alias("_near"), only(2).alias("_mine"))
    # a cell without turns of its own has no window, but a conversation of system turns only has one
    cell = cell.where((F.size("_mine") > 0) | (F.col("_cell") == 0))

    front = F.aggregate("_front", F.lit(0).cast("long"), lambda acc, t: acc + t["n"])
    room = F.greatest(F.lit(1), F.lit(budget) - F.lit(history) - front)
    start = F.struct(F.lit(0).alias("i"), F.lit(0).cast("long").alias("fill"), F.array(F.lit(0)).alias("cuts"))

    def scan(acc: Column, t: Column) -> Column:
        opens = (acc["i"] > 0) & (acc["fill"] + t["n"] > F.col("_room"))
        return F.struct((acc["i"] + 1).alias("i"), F.when(opens, t["n"]).otherwise(acc["fill"] + t["n"]).alias("fill"), F.when(opens, F.array_append(acc["cuts"], acc["i"])).otherwise(acc["cuts"]).alias("cuts"))

    cell = cell.withColumn("_room", room).withColumn("_cuts", F.aggregate("_mine", start, scan, lambda acc: acc["cuts"]))

    def span_of(begin: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_cuts", k + 1), F.size("_mine"))
        first = F.get("_mine", begin)
        back = F.filter(F.concat("_near", F.slice("_mine", F.lit(1), begin)), lambda t: t["p"] >= first["p"] - history)
        return F.struct(k.alias("k"), back.alias("back"), F.slice("_mine", begin + 1, end - begin).alias("own"))

    one = cell.select("conv_id", "_cell", "_front", F.explode(F.transform("_cuts", span_of)).alias("w"))

    def shown(mark: Column):  # noqa: ANN202
        return lambda t: F.struct(F.concat(mark, escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body"), ((t["role"] == "assistant") & (mark == TURN)).alias("train"))

    opening = F.when((F.col("_cell") == 0) & (F.col("w.k") == 0), F.lit(TURN)).otherwise(F.lit(AGAIN))
    parts = F.concat(F.transform("_front", shown(opening)), F.transform("w.back", shown(F.lit(AGAIN))), F.transform("w.own", shown(F.lit(TURN))))
    number = F.col("_cell") * F.lit(span) + F.col("w.k")  # a turn has a token at least, so a cell has fewer windows than tokens
    one = one.select("conv_id", number.alias("window"), parts.alias("_parts"))
    formatted = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,n:int>>").alias("loss"))

    def mask(acc: Column, p: Column) -> Column:
        head, body = F.char_length(p["head"]), F.char_length(p["body"])
        span = F.struct((acc["at"] + head).alias("start"), body.alias("n"))
        return F.struct((acc["at"] + head + body + len(END)).alias("at"), F.when(p["train"], F.array_append(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    return one.select("conv_id", "window", formatted.alias("formatted"), F.aggregate("_parts", begin, mask, lambda acc: acc["loss"]).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """``array<struct<again, role, text>>`` of a window, unescaped."""
    raw = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def parse(p: Column) -> Column:
        again = F.startswith(p, F.lit(AGAIN))
        rest = F.substring(p, F.when(again, F.lit(len(AGAIN) + 1)).otherwise(len(TURN) + 1), F.char_length(p))
        return F.struct(again.alias("again"), unescape(F.substring_index(rest, TEXT, 1)).alias("role"), unescape(F.substring_index(rest, TEXT, -1)).alias("text"))

    return F.transform(raw, parse)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["n"]))), "")


def digest(made: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows in order."""
    own = F.filter(read_turns(F.col("formatted")), lambda t: ~t["again"])
    each = made.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.size(own).cast("long").alias("n"),
            read_loss(F.col("formatted"), F.col("loss")).alias("loss"),
            F.char_length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    conv = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    joined = lambda c: F.array_join(F.transform("w", lambda w: w[c]), "")
    total = lambda c: F.aggregate("w", F.lit(0).cast("long"), lambda acc, w: acc + w[c])
    return conv.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
