"""Quality classifier: histogram gradient-boosted trees over document statistics.

A document becomes a row of statistics of its bytes, words and lines. Trees
are grown on the driver from a bounded sample of labelled rows (SAMPLE): each
statistic is cut into at most 64 bins, a level of a tree is one histogram of
gradients per statistic, and every node of the level takes its best split.
The trees are flattened into arrays; scoring walks all rows down a tree with a
few numpy gathers per level.

A null or empty text has all statistics zero and gets a score like any other.
A repeated label counts as bad if any is bad; null labels are not learned.
Without any labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.llm import textkit
from acreline.runtime import stored

#: Labelled rows that the model is fitted on, at most; the first by a hash of doc_id.
SAMPLE = 20_000
THRESHOLD = 0.7
TREES, DEPTH, RATE, BINS, LEAST, RIDGE = 80, 4, 0.15, 64, 10, 2.0

_CLASS = np.zeros(256, dtype=np.int32)
for _k, _set in enumerate(
    (
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b".", b",", b"!?", b"|", b"#$%&*@^~",
        b"<>{}[]()", b"-_=+/\\", b"\"'`:;", bytes(range(192, 256)), bytes(range(128, 192)),
    ),
    1,
):
    _CLASS[list(_set)] = _k
KINDS = 16
FEATURES = KINDS + 12


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES statistics per text."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    counts, same = np.zeros((rows, KINDS)), np.zeros(rows)
    for a in range(0, len(data), textkit.SLICE_BYTES):  # one step but for a long text
        part = data[a : a + textkit.SLICE_BYTES]
        row = np.searchsorted(offsets, np.arange(a, a + len(part)), "right") - 1 if rows > 1 else np.zeros(len(part), dtype=np.int64)
        counts += np.bincount(row * KINDS + _CLASS[part], minlength=rows * KINDS).reshape(rows, KINDS)
        pair = (part[1:] == part[:-1]) & (row[1:] == row[:-1])
        same += np.bincount(row[1:][pair], minlength=rows)
        if a and data[a] == data[a - 1] and np.searchsorted(offsets, a, "right") == np.searchsorted(offsets, a - 1, "right"):
            same[row[0]] += 1
    some = np.maximum(size, 1)[:, None]
    w = textkit.words(data, offsets)
    n = w.counts()
    length = (w.end - w.start).astype(np.float64)
    per = np.maximum(n, 1)
    first = w.start == offsets[w.row]
    capital = (data[w.start] >= 65) & (data[w.start] <= 90) if len(w.start) else first
    sums = lambda x: np.bincount(w.row, weights=x, minlength=rows)
    order = np.lexsort((w.h, w.row))
    h, r = w.h[order], w.row[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[fresh], minlength=rows)
    begins = np.flatnonzero(fresh)
    most = np.zeros(rows)
    np.maximum.at(most, r[begins], np.diff(np.append(begins, len(h))))
    at, g = textkit.grams(w.h, w.row, 3)
    owner = w.row[at]
    order = np.lexsort((g, owner))
    g, owner = g[order], owner[order]
    again = np.zeros(rows)
    if len(g):
        again = np.bincount(owner[1:][(g[1:] == g[:-1]) & (owner[1:] == owner[:-1])], minlength=rows)
    mean = sums(length) / per
    more = [
        np.log1p(size), np.log1p(n), mean, np.sqrt(np.maximum(sums(length**2) / per - mean**2, 0)), distinct / per, most / per, again / per, same / some[:, 0],
        sums(capital.astype(np.float64)) / per, (counts[:, 5] + 1) / per, counts[:, 1] / np.maximum(counts[:, 1] + counts[:, 2], 1), sums((length <= 2).astype(np.float64)) / per,
    ]
    return np.column_stack([counts / some, *more]).astype(np.float32)


class Trees:
    """Flattened trees: ``feature`` (-1 in a leaf), ``cut``, ``value``; node i's children are 2i+1 and 2i+2."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.cut, self.value = base, feature, cut, value

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                right = x[rows, np.maximum(f, 0)] > cut[node]
                node = np.where(f < 0, node, 2 * node + 1 + right)
            out += value[node]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    nodes = 2 ** (DEPTH + 1) - 1
    if not len(y):
        return Trees(0.0, *(np.empty((0, nodes), dtype=t) for t in (np.int64, np.float32, np.float64)))
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    n, k = x.shape
    raw = np.full(n, base)
    made = []
    flat = binned + np.arange(k) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, p * (1 - p)
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes, dtype=np.float32), np.zeros(nodes)
        node = np.zeros(n, dtype=np.int64)
        live = np.ones(n, dtype=bool)
        for level in range(DEPTH + 1):
            first, width = 2**level - 1, 2**level
            own = np.flatnonzero(live)
            local = node[own] - first
            gs, hs = np.bincount(local, grad[own], width), np.bincount(local, hess[own], width)
            value[first : first + width] = RATE * gs / (hs + RIDGE)
            if level == DEPTH or not len(own):
                break
            cell = (local[:, None] * (k * BINS) + flat[own]).ravel()
            shape = (width, k, BINS)
            g, h, c = (np.bincount(cell, np.repeat(v, k), width * k * BINS).reshape(shape).cumsum(axis=2) for v in (grad[own], hess[own], np.ones(len(own))))
            tg, th, tc = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (tg - g) ** 2 / (th - h + RIDGE) - tg**2 / (th + RIDGE)
            gain[(c < LEAST) | (tc - c < LEAST)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            splits = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            f, b = best // BINS, best % BINS
            for i in np.flatnonzero(splits):
                feature[first + i], cut[first + i] = f[i], edges[f[i]][b[i]]
            go = splits[local]
            live[own[~go]] = False
            own, local = own[go], local[go]
            node[own] = 2 * node[own] + 1 + (binned[own, f[local]] > b[local])
        raw += value[node]
        made.append((feature, cut, value))
    return Trees(base, *(np.stack(v) for v in zip(*made, strict=True)))


def with_features(docs: DataFrame) -> DataFrame:
    """``doc_id, x array<float>`` per document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, data, offsets in textkit.text_slices(batch.column(1)):
                x = features(data, offsets)
                values = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, rows), values], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(make, "doc_id long, x array<float>")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fits on at most ``sample`` labelled rows of ``rows(doc_id, x)`` that are not held out."""
    said = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = said.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    got = rows.join(F.broadcast(chosen), "doc_id").select("x", "quality").orderBy(F.xxhash64("x"), "quality").limit(sample).toPandas()
    x = np.stack(got["x"].to_numpy()).astype(np.float32) if len(got) else np.empty((0, FEATURES), dtype=np.float32)
    return fit(x, (got["quality"].to_numpy() > 0).astype(np.float64))


def score(rows: DataFrame, model: Trees) -> DataFrame:
    """``doc_id, score`` of ``rows(doc_id, x)``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(len(batch), FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(make, "doc_id long, score double")


def score_column(model: Trees, spark) -> object:  # noqa: ANN001
    """An Arrow UDF text -> score, for filtering documents in one pass."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judge(text: pa.Array) -> pa.Array:
        x = [features(data, offsets) for _, _, data, offsets in textkit.text_slices(text)]
        return pa.array(shared.value.score(np.concatenate(x)) if x else np.empty(0))

    return judge


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    rows = stored(with_features(docs), "features")
    made = score(rows, train(rows, labels, sample))
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``, all columns as they were."""
    model = train(with_features(docs.join(F.broadcast(labels.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample)), "doc_id", "left_semi")), labels, sample)
    return docs.where(score_column(model, docs.sparkSession)(F.col("text").cast("string")) >= threshold)
