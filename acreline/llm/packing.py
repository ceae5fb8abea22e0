"""Packing: best-fit decreasing over the histogram of piece lengths.

A document becomes its ids and one end id. What is longer than a window is
first cut into full windows; the rest is one shorter piece. Best-fit
decreasing puts the pieces, longest first, each into the open window with the
tightest fit. Pieces of one length are interchangeable, so the algorithm runs
on the histogram (one count per length, at most ``window`` numbers) and places
all pieces of a length that fit one kind of window at once. A segment tree
over remaining capacities finds the tightest kind. The result is a short table
of runs; every piece finds its window from its length and its number among
the pieces of that length. Nothing else reaches the driver.

Nulls: a null or empty text is the end id alone. Repeated rows are packed as
often as they occur. An empty table gives an empty result. Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreline.llm.tokens import default_path, word_tokens
from acreline.runtime import stored

WINDOW = 2048
END_ID = 1
#: Runs of the plan beyond which it is joined by shuffle instead of broadcast (about 60 bytes each); the result is the same.
BROADCAST_RUNS = 100_000
#: Pieces that are numbered in one task.
ROWS_PER_PART = 50_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """Segment tree over remaining capacities: how many windows are open at each."""

    def __init__(self, window: int):
        self.base = 1
        while self.base < window + 1:
            self.base *= 2
        self.count = [0] * (2 * self.base)

    def add(self, capacity: int, n: int) -> None:
        i = self.base + capacity
        while i:
            self.count[i] += n
            i //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` with an open window."""
        i = self.base + least
        if self.count[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.base
            i //= 2
        return None


def best_fit_decreasing(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first, last, sequence, per_window, offset)``.

    Pieces ``first <= number < last`` of that length go to the windows from
    ``sequence`` on, ``per_window`` to each, from ``offset`` in each.
    """
    tree = CapacityTree(window)
    open_at: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> ranges [a, b) of windows
    runs, fresh = [], 0

    def keep(capacity: int, a: int, b: int) -> None:
        if a < b and capacity:
            ranges = open_at.setdefault(capacity, [])
            if ranges and ranges[-1][1] == a:
                ranges[-1] = (ranges[-1][0], b)
            else:
                ranges.append((a, b))
            tree.add(capacity, b - a)

    for length in sorted(histogram, reverse=True):
        done, n = 0, histogram[length]
        while done < n:
            room = tree.tightest(length)
            if room is None:
                room, per = window, window // length
                a, b = fresh, fresh + -(-(n - done) // per)
                fresh = b
            else:
                # a window that still fits another is the tightest again, so each is filled up in turn
                a, b = open_at[room].pop()
                tree.add(room, a - b)
                per = room // length
                need = -(-(n - done) // per)
                if b - a > need:
                    keep(room, a + need, b)
                    b = a + need
            placed = min(n - done, (b - a) * per)
            runs.append((length, done, done + placed, a, per, window - room))
            full, rest = divmod(placed, per)
            keep(room - per * length, a, a + full)
            keep(room - rest * length, a + full, b)
            done += placed
    return runs


def token_pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of each document: full windows, then the shorter rest."""
    path = tokenizer or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            for at, ids, bounds in tokens.encode(batch.column(1)):
                rows = len(bounds) - 1
                n = np.diff(bounds) + 1
                pieces = -(-n // window)
                total = int(pieces.sum())
                row = np.repeat(np.arange(rows), pieces)
                start = (np.arange(total) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, n[row] - start)
                raw, end = memoryview(ids.astype("<u4").tobytes()), np.array([END_ID], dtype="<u4").tobytes()
                crc = np.empty(total, dtype=np.int64)
                begin = bounds[row] + start
                for i, (a, m, last) in enumerate(zip(begin.tolist(), length.tolist(), (start + length == n[row]).tolist(), strict=True)):
                    crc[i] = zlib.crc32(end, zlib.crc32(raw[4 * a : 4 * (a + m - 1)])) if last else zlib.crc32(raw[4 * a : 4 * (a + m)])
                ids_of = batch.column(0).slice(at, rows).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([ids_of.cast(pa.int64()), pa.array(start), pa.array(length), pa.array(crc), pa.array(n[row])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces (``length`` at most ``window``)."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = best_fit_decreasing(histogram, window)
    parts = sum(histogram.values()) // ROWS_PER_PART + 1
    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    base = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n")).select("length", "_part", F.coalesce(before, F.lit(0)).alias("_base"))
    number = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "start", "ids_crc32")) - 1
    dealt = dealt.withColumn("_number", number).join(base, ["length", "_part"]).withColumn("_number", F.col("_number") + F.col("_base"))
    plan = spark.createDataFrame(runs, "length long, _first long, _last long, _seq long, _per long, _off long")
    if len(runs) <= BROADCAST_RUNS:
        plan = F.broadcast(plan)
    step = F.col("_number") - F.col("_first")
    return dealt.join(plan, (dealt["length"] == plan["length"]) & (F.col("_number") >= F.col("_first")) & (F.col("_number") < F.col("_last"))).select(
        *(dealt[c] for c in pieces.columns),
        (F.col("_seq") + F.floor(step / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_off") + step % F.col("_per") * dealt["length"]).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """Where each piece of each document goes: PIECES and ``sequence_id, offset``."""
    return place(stored(token_pieces(docs, window, tokenizer), "pieces"), window)


def sequences(docs: DataFrame, packed: DataFrame, window: int = WINDOW, tokenizer: str | None = None, pad_id: int = 0) -> DataFrame:
    """The packed ids: ``sequence_id, ids array<int>, n_tokens``.

    Padded to the window, except where the number of ids is a power of two.
    A piece finds its ids by its document's id, its start and its checksum,
    so null and repeated ids keep all their pieces; equal pieces are
    interchangeable and numbered.
    """
    path = tokenizer or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            for at, ids, bounds in tokens.encode(batch.column(1)):
                for r in range(len(bounds) - 1):
                    own = np.append(ids[bounds[r] : bounds[r + 1]], np.uint32(END_ID)).astype("<u4")
                    starts = np.arange(0, len(own), window)
                    parts = [own[a : a + window] for a in starts]
                    values = pa.ListArray.from_arrays(pa.array(np.append(starts, len(own)).astype(np.int32)), pa.array(own.astype(np.int32)))
                    one = batch.column(0).slice(at + r, 1).take(pa.array(np.zeros(len(parts), dtype=np.int64)))
                    yield pa.RecordBatch.from_arrays([one, pa.array(starts), pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()), values], ["doc_id", "start", "ids_crc32", "ids"])

    key = ("doc_id", "start", "ids_crc32")
    numbered = lambda df, order: df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
    cast = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = numbered(cast.mapInArrow(cut, "doc_id long, start long, ids_crc32 long, ids array<int>"), "ids").alias("p")
    places = numbered(packed.select(*key, "sequence_id", "offset"), "sequence_id").alias("q")
    same = F.lit(True)
    for c in (*key, "_n"):
        same &= F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}"))
    whole = pieces.join(places, same).groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    return whole.select("sequence_id", F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(window) - n))).alias("ids"), n.alias("n_tokens"))
