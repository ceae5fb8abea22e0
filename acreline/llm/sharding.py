"""Sharding by histogram sort, with DataFrame functions only.

Documents are ordered by (hash of text, hash of id), so equal texts stand
together. Splitters cut that order into shards of nearly equal bytes. They are
found by counting: bytes below candidate boundaries are summed exactly over
all partitions, 4096 candidates at a time; each round refines only the
candidate interval that holds a splitter's target, until the interval is
narrower than the tolerance or a single key. The driver sees counts per
candidate only. With the splitters known, every row's shard is a comparison,
and writing the shards takes one exchange.

A boundary between different texts within the tolerance is taken before one
inside a group of equal texts; a larger group is cut between its copies.
Null ids and repeated rows are placed like others (equal rows share a shard
where the law allows it); a null text has no bytes. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreline.runtime import stored

N_SHARDS = 40
#: A splitter may be off its target by this part of a shard, to keep equal texts together.
TOLERANCE = 0.01
OVERHEAD = 16
#: Rows of a shard that are numbered in one task, whatever the number of rows or of equal texts.
ROWS_PER_PART = 50_000
#: Bytes that one task writes of a shard.
TASK_BYTES = 256 << 20

_BITS = 12
_WIDTH = 1 << _BITS
#: Digits of a 128-bit key, most significant first: (column, right shift, number of bits).
_DIGITS = [(c, max(0, 64 - _BITS * (i + 1)), min(_BITS, 64 - _BITS * i)) for c in ("_h", "_i") for i in range(6)]


def _digit(k: int) -> Column:
    column, shift, bits = _DIGITS[k]
    return F.shiftrightunsigned(F.col(column), shift).bitwiseAND(F.lit((1 << bits) - 1))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, _h, _i``: what sharding needs of a document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_h"),
        F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(7)).alias("_i"),
    )


def splitters(keys: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE) -> list[list[int]]:
    """Ascending splitters, each the digits of the first key of a shard (missing ones are 0)."""
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    allowed = total / n_shards * tolerance
    found: dict[int, list[int]] = {}
    # splitter -> (digits so far, bytes before that interval)
    active: dict[int, tuple[tuple[int, ...], int]] = {i: ((), 0) for i in range(1, n_shards)} if total else {}
    for depth in range(len(_DIGITS)):
        if not active:
            break
        prefixes = {p for p, _ in active.values()}
        rows = keys
        for k in range(depth):  # a row stays while its digits are a prefix in use: at most one per splitter
            rows = rows.where(_digit(k).isin(sorted({p[k] for p in prefixes})))
        digits = [_digit(k).alias(f"_{k}") for k in range(depth + 1)]
        counted: dict[tuple[int, ...], dict[int, int]] = {}
        single = set()
        for r in rows.groupBy(*digits).agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect():
            if tuple(r[:depth]) in prefixes:
                counted.setdefault(tuple(r[:depth]), {})[r[depth]] = r["n"]
                if r["rows"] == 1:
                    single.add(tuple(r[: depth + 1]))
        still = {}
        for i, (prefix, below) in active.items():
            target = total * i / n_shards
            at, own = below, counted[prefix]
            for digit in sorted(own):
                if at + own[digit] >= target:
                    break
                at += own[digit]
            low, high = target - at, at + own[digit] - target
            last = depth + 1 == len(_DIGITS) or (*prefix, digit) in single
            inside = depth >= 6  # the text's hash is used up: the cut is between equal texts
            if min(low, high) <= allowed and not inside or low == 0 or last:
                found[i] = [*prefix, digit] if low <= high else [*prefix, digit + 1]
            else:
                still[i] = ((*prefix, digit), at)
        active = still
    made = []
    for i in sorted(found):
        digits = found[i] + [0] * (len(_DIGITS) - len(found[i]))
        for k in range(len(_DIGITS) - 1, 0, -1):  # carry
            if digits[k] >> _DIGITS[k][2]:
                digits[k - 1] += 1
                digits[k] = 0
        made.append(max(digits, made[-1]) if made else digits)
    return made


def _halves(digits: list[int]) -> tuple[int, int] | None:
    """The splitter as two unsigned numbers; None beyond all keys."""
    value = [0, 0]
    for k, d in enumerate(digits):
        value[k // 6] |= d << _DIGITS[k][1]
    return None if value[0] >> 64 else (value[0], value[1])


def _signed(x: int) -> int:
    """An unsigned 64-bit number in the order of Spark's signed longs."""
    return x - (1 << 63)


def _shard(found: list[list[int]]) -> Column:
    """How many splitters are at or below a row's key."""
    high = F.col("_h").bitwiseXOR(F.lit(-(1 << 63)))
    low = F.col("_i").bitwiseXOR(F.lit(-(1 << 63)))
    shard = F.lit(0)
    for digits in found:
        if (at := _halves(digits)) is not None:
            a, b = (F.lit(_signed(x)) for x in at)
            shard = shard + ((high > a) | (high == a) & (low >= b)).cast("int")
    return shard


def assign(docs: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document."""
    keys = stored(keyed(docs), "keys")
    shard = _shard(splitters(keys, n_shards, tolerance))
    # slots: rows are numbered in parts of a shard, and the parts' sizes are summed
    parts = keys.count() // ROWS_PER_PART + 1
    dealt = keys.withColumns({"shard": shard, "_part": F.pmod(F.xxhash64("_h", "_i"), F.lit(parts))})
    sizes = dealt.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("shard", "_part", F.coalesce(before, F.lit(0)).alias("_base"))
    number = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_h", "_i", "doc_id")) - 1
    return dealt.withColumn("_number", number).join(sizes, ["shard", "_part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("_number") + F.col("_base")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE, max_rows_per_file: int = 1_000_000) -> str:
    """Writes the documents, one folder ``shard=k`` each, after one exchange by shard and part.

    All columns stay as they were; where docs has a ``shard`` of its own, the
    folders are named with underscores behind it. The name is returned.
    """
    keys = stored(keyed(docs), "keys")
    shard = _shard(splitters(keys, n_shards, tolerance))
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = total // n_shards // TASK_BYTES + 1  # of each shard
    name = "shard"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    full = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(text).alias("_h"), F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(7)).alias("_i"))
    dealt = full.withColumn("_shard", shard).repartition(n_shards * tasks, "_shard", F.pmod(F.xxhash64("_h", "_i"), F.lit(tasks)))
    dealt.select("row.*", F.col("_shard").alias(name)).write.option("maxRecordsPerFile", max_rows_per_file).partitionBy(name).parquet(path)
    return name
