"""Approximate nearest neighbours by score-aware quantisation.

Vectors are scaled to unit length, so the largest cosine is the largest inner
product. They are dealt to leaves (spherical k-means); within a leaf, what is
left after the leaf's centre is quantised to four bits per two dimensions with
the anisotropic loss, which weighs an error along the vector more than one
across it. A query probes some leaves, scans their codes with small tables and
ranks the best again by the exact cosine of the original vectors in double
precision.

The index is fitted on a bounded sample (SAMPLE vectors, by a hash of vec_id);
every vector is indexed. The number of leaves to probe comes from the sample
too: the fewest that hold PROBE_RECALL of the nearest neighbours of up to 500
sampled vectors. A query that finds fewer neighbours than there are probes
all leaves. Equal vectors are one class with its smallest ids; a leaf's
vectors and its queries are each split into salted blocks of bounded size, and
all of the former meet all of the latter.
Where a block holds more vectors that the codes cannot tell apart than are
ranked again, such as a large group of near copies, all of it is ranked.

Vectors of different length have no cosine, so each length has neighbours of
its own: an index for the most frequent length and for every other of more
than BLOCK_ROWS vectors; fewer are compared exactly. Vectors that are null,
empty, zero or hold null or non-finite numbers take no part, nor do rows with
a null vec_id. Repeated rows count once; of rows that share a vec_id the
smallest vector counts. Other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreline.llm import annindex
from acreline.runtime import stored

NEAREST = 5
SAMPLE = 20_000
PROBE_RECALL = 0.985
LEAF_ROWS, BLOCK_ROWS, QUERY_ROWS = 2048, 4096, 4096
#: Sampled vectors that a leaf is fitted on, at least; the bounded sample so bounds the leaves.
LEAF_SAMPLE = 8
#: Candidates of each block that are ranked exactly.
RERANK = 192


RESULT = "query_id long, rank int, vec_id long, score double"


def valid_vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, vec array<double>`` of the vectors that take part, once per id."""
    vec = F.col(column).cast("array<double>")
    good = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and size(vec) > 0")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return good.where(fine).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _unit(batch: pa.Array) -> np.ndarray:
    """Unit rows in double precision; scaled first, so that no square overflows."""
    x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _fit(classes: DataFrame, n: int, sample: int) -> tuple[annindex.Index, int]:
    rows = classes.select("rep", "vec").where(F.pmod(F.xxhash64("rep"), F.lit(n)) < 2 * sample).orderBy(F.xxhash64("rep"), "rep").limit(sample)
    x = _unit(rows.select("vec").toArrow().column(0).combine_chunks()).astype(np.float32)
    leaves = max(1, min(math.ceil(n / LEAF_ROWS), len(x) // LEAF_SAMPLE))
    index = annindex.fit(x, leaves)
    asked = np.arange(min(500, len(x)))
    s = x[asked] @ x.T
    s[asked, asked] = -2
    k = min(NEAREST, len(x) - 1)
    if not k or leaves == 1:
        return index, leaves
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    order = np.argsort(-(x[asked] @ index.centres.T), axis=1).argsort(axis=1)
    rank = np.take_along_axis(order, index.leaf(x)[near], axis=1)
    return index, min(leaves, int(np.quantile(rank, PROBE_RECALL)) + 2)


def _search(table: pa.Table, index: annindex.Index, keep: int, rerank: int) -> pa.Table:
    """One block: rows with codes are candidates, rows without are queries."""
    table = table.combine_chunks()
    queries = table.column("codes").combine_chunks().is_null().to_numpy(zero_copy_only=False)
    rep = table.column("rep").to_numpy()
    vec = table.column("vec").combine_chunks()
    mine, theirs = np.flatnonzero(queries), np.flatnonzero(~queries)
    empty = pa.table({"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not len(mine) or not len(theirs):
        return empty
    theirs = theirs[np.argsort(rep[theirs])]
    x, leaf = _unit(vec.take(pa.array(theirs))), int(table.column("leaf")[0].as_py())
    packed = np.frombuffer(b"".join(table.column("codes").take(pa.array(theirs)).to_pylist()), dtype=np.uint8).reshape(len(theirs), -1)
    out = []
    top, best = min(rerank, len(theirs)), min(keep, len(theirs))
    for a in range(0, len(mine), 256):
        own = mine[a : a + 256]
        q = _unit(vec.take(pa.array(own)))
        rough = index.scan(q.astype(np.float32), leaf, packed)
        found = np.argpartition(-rough, top - 1, axis=1)[:, :top] if top < len(theirs) else np.tile(np.arange(len(theirs)), (len(own), 1))
        found.sort(axis=1)
        exact = np.einsum("qd,qkd->qk", q, x[found])
        order = np.argsort(-exact, axis=1, kind="stable")[:, :best]
        hits, scores = np.take_along_axis(found, order, axis=1), np.take_along_axis(exact, order, axis=1)
        if top < len(theirs):
            # where more are within the codes' error of the best than were ranked, the whole block is
            edge = -np.partition(-rough, best - 1, axis=1)[:, best - 1] - 2 * index.noise
            for i in np.flatnonzero((rough >= edge[:, None]).sum(axis=1) > top):
                every = x @ q[i]
                hits[i] = np.argsort(-every, kind="stable")[:best]
                scores[i] = np.einsum("kd,d->k", x[hits[i]], q[i])
        out.append((np.repeat(rep[own], best), rep[theirs][hits].ravel(), scores.ravel()))
    return pa.table(dict(zip(("query", "rep", "score"), (pa.array(np.concatenate(v)) for v in zip(*out, strict=True)), strict=True)))


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEAREST, sample: int = SAMPLE, rerank: int = RERANK, column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of each of ``queries(vec_id)`` but itself."""
    spark = rows.sparkSession
    vectors = valid_vectors(rows, column).withColumn("dim", F.size("vec"))
    sizes = Counter({r[0]: r[1] for r in vectors.groupBy("dim").count().collect()})
    if not sizes:
        return spark.createDataFrame([], RESULT)
    keyed = stored(vectors.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")}), "vectors")
    wanted = queries.select(F.col("vec_id").cast("long")).distinct()
    most = max(sizes, key=lambda d: (sizes[d], d))
    indexed = [d for d in sorted(sizes) if d == most or sizes[d] > BLOCK_ROWS]
    made = [_nearest(keyed.where(F.col("dim") == d).drop("dim"), wanted, sizes[d], k, sample, rerank) for d in indexed]
    if len(indexed) < len(sizes):
        made.append(_compared(keyed.where(~F.col("dim").isin(indexed)), wanted, k))
    return reduce(DataFrame.union, made)


def _compared(keyed: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The same for lengths of at most BLOCK_ROWS vectors, each in one group."""

    def rank(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        ids, x = table.column("vec_id").to_numpy(), _unit(table.column("vec").combine_chunks())
        out = []
        for i in np.flatnonzero(table.column("asked").to_numpy(zero_copy_only=False)):
            score = x @ x[i]
            score[i] = -np.inf
            best = np.argsort(-score, kind="stable")[: min(k, len(ids) - 1)]
            out.append((np.full(len(best), ids[i]), np.arange(1, len(best) + 1), ids[best], score[best]))
        parts = [np.concatenate(v) for v in zip(*out, strict=True)] if out else [np.empty(0)] * 4
        return pa.table([pa.array(v, t) for v, t in zip(parts, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], ["query_id", "rank", "vec_id", "score"])

    flagged = keyed.select("dim", "vec_id", "vec").join(wanted.withColumn("asked", F.lit(True)), "vec_id", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    return flagged.groupBy("dim").applyInArrow(rank, RESULT)


def _nearest(keyed: DataFrame, wanted: DataFrame, total: int, k: int, sample: int, rerank: int) -> DataFrame:
    """The same for vectors of one length, by index."""
    spark = keyed.sparkSession
    number = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    few = keyed.withColumn("_n", number).where(F.col("_n") <= k + 1)
    classes = few.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.min("vec").alias("vec"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = stored(classes, "classes")
    n = classes.count()
    index, probes = _fit(classes, n, sample)
    leaves = len(index.centres)
    shared = spark.sparkContext.broadcast(index)

    def encode(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            if len(batch):
                leaf, packed = shared.value.encode(_unit(batch.column(1)).astype(np.float32))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf, pa.int32()), pa.array([p.tobytes() for p in packed], pa.binary())], ["rep", "vec", "leaf", "codes"])

    coded = stored(classes.select("rep", "vec").mapInArrow(encode, "rep long, vec array<double>, leaf int, codes binary"), "codes")
    asked = keyed.join(wanted, "vec_id", "left_semi").select("vec_id", "h1", "h2")
    who = asked.join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"))
    who = stored(who, "asked")
    parts = lambda df, size, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias(name))
    sizes = parts(coded, BLOCK_ROWS, "blocks")  # a row per leaf

    def search(who: DataFrame, probes: int) -> DataFrame:
        """``query_id, best``: the nearest found, and the query itself."""

        def probe(batches):  # noqa: ANN001, ANN202
            for batch in batches:
                if len(batch):
                    leaf = shared.value.probes(_unit(batch.column(1)).astype(np.float32), probes)
                    row = pa.array(np.repeat(np.arange(len(batch)), leaf.shape[1]))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(leaf.ravel(), pa.int32())], ["rep", "leaf"])

        reps = classes.select("rep", "vec").join(who.select(F.col("query").alias("rep")).distinct(), "rep", "left_semi")
        reps = stored(reps, "queries")
        probed = stored(reps.mapInArrow(probe, "rep long, leaf int"), "probed")
        both = F.broadcast(sizes.join(parts(probed, QUERY_ROWS, "turns"), "leaf"))
        every = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
        dealt = lambda n, name: F.pmod(F.xxhash64("rep"), n).cast("int").alias(name)
        cells = coded.join(both, "leaf").select("leaf", dealt("blocks", "block"), every("turns", "turn"), "rep", "vec", "codes")
        sent = probed.join(both, "leaf").select("leaf", every("blocks", "block"), dealt("turns", "turn"), "rep").join(reps, "rep")
        sent = sent.select("leaf", "block", "turn", "rep", "vec", F.lit(None).cast("binary").alias("codes"))
        found = cells.union(sent).groupBy("leaf", "block", "turn").applyInArrow(lambda t: _search(t, shared.value, k + 1, rerank), "query long, rep long, score double")
        better = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
        best = found.withColumn("_n", F.row_number().over(better)).where(F.col("_n") <= k + 1).join(classes.select("rep", "ids"), "rep")
        each = best.select("query", F.explode("ids").alias("vec_id"), (-F.col("score")).alias("far"))
        listed = each.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "vec_id"))), 1, k + 1).alias("best"))
        others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
        return stored(who.join(listed, "query", "left").select("query_id", "query", F.coalesce(others, F.array().cast("array<struct<far:double,vec_id:long>>")).alias("best")), "listed")

    listed = search(who, probes)
    if probes < leaves:
        short = F.size("best") < min(k, total - 1)
        again = stored(listed.where(short).select("query_id", "query"), "short")
        if not again.isEmpty():
            listed = listed.where(~short).union(search(again, leaves))
    return listed.select("query_id", F.posexplode("best").alias("_p", "b")).select("query_id", (F.col("_p") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.far")).alias("score"))
