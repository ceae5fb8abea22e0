"""Benchmark decontamination by winnowing.

The words of a text give 5-gram hashes; the smallest in every window of 6
consecutive ones (10 words) is that window's fingerprint (Schleimer, Wilkerson
and Aiken, "Winnowing", 2003). Two texts that share 10 consecutive words have
the same fingerprint there, so no shared span of 10 words is missed. Training
and benchmark fingerprints are joined; a pair is a hit if two independent
64-bit hashes of the whole windows agree too. Hits of a document are extended:
windows that overlap or adjoin become one span.

An item of fewer than 10 words, but not none, is one window of all its words,
with its hash for a fingerprint.

Neither texts nor fingerprints pass the driver. A bitmap of the benchmark's
fingerprints, of a fixed size, tells most of a document's fingerprints from
it where they are made; what is left is joined, by broadcast if the
benchmark's windows were counted to be few, else on salted keys. The verdict
goes back by id and hash of text, and a second bitmap leaves clean texts where
they are.

Nulls: a null text has no words; a document or item without words matches
nothing. Null item ids count as the id ``null``. Repeated document rows get a
row each. Other columns are ignored, or left as they were. Empty tables give
no hits or no rows. A long text is worked on in blocks of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreline.llm import textkit
from acreline.llm.bitmap import BITS, bitmap, marked
from acreline.runtime import stored

SPAN, GRAM = 10, 5
#: Benchmark windows (some 60 bytes each) up to which they are broadcast; more are joined on salted keys.
BROADCAST_WINDOWS = 200_000
SALT = 16
#: Words that are worked on at once.
BLOCK_WORDS = 1 << 18

_KEY = ("n", "fp", "h", "h2")
_PRINT = np.dtype([("row", "i8"), ("start", "i8"), ("n", "i4"), ("fp", "u8"), ("h", "u8"), ("h2", "u8")])


def _gather(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each position, as textkit.grams makes them."""
    with np.errstate(over="ignore"):
        g = np.full(len(at), k, dtype=np.uint64)
        for j in range(k):
            g = g * np.uint64(0xD6E8FEB86659FD93) + h[at + j]
    return textkit.mix(g)


def winnow(h: np.ndarray, row: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows inside one text, of texts laid end to end, and their fingerprints."""
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    g = _gather(h, np.arange(len(h) - gram + 1), gram)
    least = g[:n].copy()
    for j in range(1, span - gram + 1):
        np.minimum(least, g[j : j + n], out=least)
    at = np.flatnonzero(row[:n] == row[span - 1 : span - 1 + n])
    return at, least[at]


def prints(w: textkit.Words, lengths: list[int], whole: bool, bits: np.ndarray | None = None) -> np.ndarray:
    """Windows of ``lengths`` words (with ``whole``, shorter ones only where they are all of a text) as _PRINT records.

    ``bits`` is a bitmap of the fingerprints that matter.
    """
    counts = w.counts()
    made = []
    for a in range(0, len(w.h), BLOCK_WORDS):
        for n in lengths:
            part = slice(a, a + BLOCK_WORDS + n - 1)
            h, h2, row = w.h[part], w.h2[part], w.row[part]
            at, fp = winnow(h, row, n, GRAM) if n == SPAN else textkit.grams(h, row, n)
            use = np.ones(len(at), dtype=bool)
            if whole and n < SPAN:
                use = counts[row[at]] == n
            if bits is not None:
                low = fp & np.uint64(BITS - 1)
                use &= bits[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1) != 0
            at, fp = at[use], fp[use]
            one = np.empty(len(at), dtype=_PRINT)
            one["row"], one["start"], one["n"], one["fp"], one["h"], one["h2"] = row[at], at + a, n, fp, _gather(h, at, n), _gather(h2, at, n)
            made.append(one)
    return np.concatenate(made) if made else np.empty(0, dtype=_PRINT)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``n, fp, h, h2, item``: every window of every item once."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, data, offsets in textkit.text_slices(batch.column(1)):
                one = prints(textkit.words(data, offsets, second=True), [*range(1, SPAN), SPAN], whole=True)
                items = batch.column(0).slice(at, rows).take(pa.array(one["row"]))
                yield pa.RecordBatch.from_arrays([pa.array(one["n"]), *(_longs(one[c]) for c in ("fp", "h", "h2")), items], [*_KEY, "item"])

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    return benchmark.select(item.alias("item"), F.col("text").cast("string")).mapInArrow(make, "n int, fp long, h long, h2 long, item string").distinct()


def document_windows(docs: DataFrame, lengths: list[int], bits: np.ndarray) -> DataFrame:
    """``doc_id, text_hash, n_words, found``: per row of docs its windows whose fingerprint is in the bitmap.

    ``found`` has first words, numbers of words, byte ranges and hashes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    fields = [("start", pa.int64()), ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("fp", pa.int64()), ("h", pa.int64()), ("h2", pa.int64())]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, data, offsets in textkit.text_slices(batch.column(2)):
                w = textkit.words(data, offsets, second=True)
                one = prints(w, lengths, whole=False, bits=shared.value)
                one = one[np.argsort(one["row"], kind="stable")]
                counts = w.counts()
                first = np.cumsum(counts) - counts
                row, start = one["row"], one["start"]
                columns = [start - first[row], one["n"].astype(np.int32), w.start[start] - offsets[row], w.end[start + one["n"] - 1] - offsets[row]]
                found = pa.StructArray.from_arrays([*map(pa.array, columns), *(_longs(one[c]) for c in ("fp", "h", "h2"))], fields=[pa.field(*f) for f in fields])
                bounds = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, rows) for i in (0, 1)), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(bounds, found)], ["doc_id", "text_hash", "n_words", "found"])

    text = F.col("text").cast("string")
    kind = "doc_id long, text_hash long, n_words long, found array<struct<start:long,n:int,a:long,b:long,fp:long,h:long,h2:long>>"
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(make, kind)


def _met(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int) -> tuple[DataFrame, DataFrame]:
    """The stored rows of docs with a number ``uid``, and ``uid, start, n, a, b, item`` of all hits."""
    known = stored(benchmark_windows(benchmark), "benchmark")
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())  # SPAN of them at most
    words = bitmap(known, F.col("fp")).toArrow()  # BITS / 64 rows at most
    bits = np.zeros(BITS // 64, dtype=np.uint64)
    bits[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    rows = stored(document_windows(docs, lengths, bits).withColumn("uid", F.monotonically_increasing_id()), "windows")
    asked = rows.select("uid", F.inline("found"))
    if known.count() <= broadcast_windows:
        return rows, asked.join(F.broadcast(known), list(_KEY)).select("uid", "start", "n", "a", "b", "item")
    salted = known.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows, asked.withColumn("_s", F.pmod("uid", F.lit(SALT)).cast("int")).join(salted, [*_KEY, "_s"]).select("uid", "start", "n", "a", "b", "item")


def find_contamination(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, spans, items``.

    ``spans`` are byte ranges of the UTF-8 text; ``items`` the sorted ids of
    the items of which a window occurs. Adjoining spans are one.
    """
    rows, hits = _met(docs, benchmark, broadcast_windows)
    hits = stored(hits, "hits")
    items = hits.select("uid", "item").distinct().groupBy("uid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    spots = hits.select("uid", "start", "n", "a", "b").distinct()
    order = Window.partitionBy("uid").orderBy("start", "n")
    reach = F.max(F.col("start") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    spots = spots.withColumn("_new", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int"))
    spots = spots.withColumn("_k", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = spots.groupBy("uid", "_k").agg((F.max(F.col("start") + F.col("n")) - F.min("start")).alias("_n"), F.min("a").alias("start"), F.max("b").alias("end"))
    found = runs.groupBy("uid").agg(F.sum("_n").alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")).join(items, "uid")
    none = "array<struct<start:long,end:long>>"
    return rows.select("uid", "doc_id", "n_words").join(found, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("spans", F.array().cast(none)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """The documents in which no window of an item occurs, all columns as they were.

    Rows equal in id and text share the verdict; null ids and texts are kept
    like others; only texts that may be contaminated are exchanged.
    """
    rows, hits = _met(docs, benchmark, broadcast_windows)
    bad = rows.join(hits.select("uid").distinct(), "uid", "left_semi").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    bad = stored(bad, "contaminated")
    known = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_hash"))
    known = marked(known, bitmap(bad, F.xxhash64("_d", "_t")), F.xxhash64("_id", "_hash"))
    kept = known.where("_may").join(bad, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_t")), "left_anti")
    return known.where("not _may").select("row.*").union(kept.select("row.*"))


#: find_contamination in SQL, window by window; its columns are those of the registered query.
ORACLE = f"""
with d as (select row_number() over () as rid, doc_id, {textkit.words_sql("text")} as w from documents),
b as (select coalesce(item_id::varchar, 'null') as item, {textkit.words_sql("text")} as w from benchmark),
bw as (select distinct item, least({SPAN}, len(w)) as n, array_to_string(w[i : i + least({SPAN}, len(w)) - 1], ' ') as g
       from b, unnest(range(1, len(w) - least({SPAN}, len(w)) + 2)) t(i) where len(w) > 0),
dw as (select rid, i, n, array_to_string(w[i : i + n - 1], ' ') as g from d, (select distinct n from bw) s, unnest(range(1, len(w) - n + 2)) t(i)),
m as (select rid, i, n, item from dw join bw using (n, g)),
h as (select rid, count(distinct k) as hits from (select rid, unnest(range(i, i + n)) as k from m) group by rid),
s as (select rid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from m group by rid)
select doc_id, len(w) as n_words, coalesce(hits, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, hits is not null as contaminated
from d left join h using (rid) left join s using (rid)
"""
