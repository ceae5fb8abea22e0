"""N-gram Jaccard join by MinHash banding.

Documents with one set of 5-word shingles are a class of copies; everything
below works on one numbered representative per class, its smallest doc_id. MinHash
signatures are cut into bands; band and row counts come from the wanted recall
at the threshold. Representatives are shuffled on band hashes. Those that meet
in a band are verified on their full shingle sets.

Verification never lists the pairs of a bucket. Representatives that meet are
connected into candidate components, and these are cut into blocks of bounded
size; two blocks are compared if any band joins them, and a comparison is a product of sparse 0/1 matrices in slices of rows and
columns, of which no more than one is held. A row leaves it per representative: how many documents it is linked to there,
and one link to the smallest representative of its part. Links are then
connected into classes.

Words are those of ``textkit``. A document of fewer than five words, but not
none, is one shingle; one without words (or a null text) links to nothing and
is its own class. A document is known by its ``doc_id`` and a hash of its text:
rows equal in both are one, rows that share an id only are compared like any
others. A row with a null id gets a null class and no links. Other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreline.llm import textkit
from acreline.operators.blocks import roots
from acreline.operators.graph import connected_components
from acreline.runtime import stored

SHINGLE = 5
THRESHOLD = 0.8
#: Share of pairs at exactly the threshold that meet in a band; more similar ones meet more surely.
RECALL = 0.9995
#: Size of a block of representatives, in UTF-8 bytes of text and ROW_BYTES more for each.
BLOCK_BYTES, ROW_BYTES = 4 << 20, 1000
#: Cells of one dense slice in a comparison, and of its result that is held at once.
CELLS = 1 << 20


def choose_bands(threshold: float, recall: float, most: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows per band that reach the recall with ``most`` hashes or less."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def _hashers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n fixed random affine permutations of the 32-bit numbers."""
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of each permutation over the shingles' low halves."""
    low = shingles.astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(low), 4096):
            np.minimum(out, (a[:, None] * low[None, i : i + 4096] + b[:, None]).min(axis=1), out=out)
    return out


def _text_hash() -> F.Column:
    return F.xxhash64(F.col("text").cast("string"))


def signed_docs(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, h, n_bytes, k1, k2, bands``: the text's hash, a 128-bit key of the shingle set and a hash per band.

    Documents without words have null keys.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _hashers(bands * rows)
        for batch in batches:
            for at, n, data, offsets in textkit.text_slices(batch.column(1)):
                keys = np.zeros((n, 2), dtype=np.uint64)
                hashes: list[np.ndarray | None] = [None] * n
                with np.errstate(over="ignore"):
                    for i, s in enumerate(textkit.shingle_sets(textkit.words(data, offsets), SHINGLE)):
                        if len(s):
                            keys[i] = s.sum(dtype=np.uint64) + np.uint64(len(s)), textkit.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                            parts = signature(s, a, b).reshape(bands, rows).astype(np.uint64)
                            h = np.arange(bands, dtype=np.uint64)
                            for j in range(rows):
                                h = textkit.mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
                            hashes[i] = h.view(np.int64)
                none = np.array([x is None for x in hashes])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        batch.column(2).slice(at, n),
                        pa.array(np.diff(offsets)),
                        pa.array(keys[:, 0].view(np.int64), mask=none),
                        pa.array(keys[:, 1].view(np.int64), mask=none),
                        pa.array(hashes, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "h", "n_bytes", "k1", "k2", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _text_hash().alias("h")).where("doc_id is not null").mapInArrow(sign, "doc_id long, h long, n_bytes long, k1 long, k2 long, bands array<long>")


class _Sets:
    """Some documents' shingle sets as one sparse matrix."""

    def __init__(self, texts: pa.Array):
        sets = [s for _, _, data, offsets in textkit.text_slices(texts) for s in textkit.shingle_sets(textkit.words(data, offsets), SHINGLE)]
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.row = np.repeat(np.arange(len(sets)), self.size)
        self.col = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)


def _links(x: _Sets, y: _Sets, threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row, column) of the links of some rows of x at a time, a bounded number of cells; of x with itself without its own."""
    n, m = len(x.size), len(y.size)
    shared = np.intersect1d(x.col, y.col)
    if x is y:  # a shingle of one document is shared with none
        one, counts = np.unique(x.col, return_counts=True)
        shared = one[counts > 1]
    if not len(shared):
        return

    def found(s: _Sets) -> tuple[np.ndarray, np.ndarray]:
        p = np.searchsorted(shared, s.col)
        p[p == len(shared)] = 0
        ok = shared[p] == s.col
        return p[ok], s.row[ok]

    (px, rx), (py, ry) = found(x), found(y)
    order = np.argsort(py, kind="stable")
    py, ry = py[order], ry[order]
    height = max(1, CELLS // m)
    for top in range(0, n, height):
        rows = min(height, n - top)
        i, j = np.searchsorted(rx, [top, top + rows])
        columns, p = np.unique(px[i:j], return_inverse=True)
        order = np.argsort(p, kind="stable")
        p, r = p[order], rx[i:j][order] - top
        begin, end = np.searchsorted(py, columns), np.searchsorted(py, columns, "right")
        both = np.zeros((rows, m), dtype=np.float32)
        width = max(1, CELLS // max(rows, m))
        for a in range(0, len(columns), width):
            b = min(a + width, len(columns))
            i, j = np.searchsorted(p, [a, b])
            ux, ix = np.unique(r[i:j], return_inverse=True)
            times = end[a:b] - begin[a:b]
            at = np.repeat(begin[a:b] - np.cumsum(times) + times, times) + np.arange(times.sum())
            uy, iy = np.unique(ry[at], return_inverse=True)
            dx = np.zeros((len(ux), b - a), dtype=np.float32)
            dx[ix, p[i:j] - a] = 1
            dy = np.zeros((len(uy), b - a), dtype=np.float32)
            dy[iy, np.repeat(np.arange(b - a), times)] = 1
            both[np.ix_(ux, uy)] += dx @ dy.T
        link = both >= threshold * (x.size[top : top + rows, None] + y.size[None, :] - both) - 1e-6
        link &= both > 0
        if x is y:
            link[np.arange(rows), top + np.arange(rows)] = False
        yield top, *np.nonzero(link)


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """One comparison: rows with side 0 or 1, or side 0 alone against itself."""
    table = table.combine_chunks()
    table = table.take(pc.sort_indices(table.column("rep")))  # so the smallest row of a part has its smallest id
    side, copies = table.column("side").to_numpy(), table.column("copies").to_numpy()
    text = table.column("text").combine_chunks()
    mine, theirs = (np.flatnonzero(side == s) for s in (0, 1))
    x = y = _Sets(text.take(pa.array(mine)))
    if alone := not len(theirs):
        theirs = mine
    else:
        y = _Sets(text.take(pa.array(theirs)))
    links, part = np.zeros(len(table)), np.arange(len(table))
    for top, i, j in _links(x, y, threshold):
        u, v = mine[top + i], theirs[j]
        links += np.bincount(u, weights=copies[v], minlength=len(table))
        if not alone:
            links += np.bincount(v, weights=copies[u], minlength=len(table))
        met = np.unique(part[u] * len(table) + part[v])
        part = roots(len(table), met // len(table), met % len(table))[part]
    some = pa.array(np.flatnonzero(links))
    rep = table.column("rep")
    textkit.release()
    return pa.table({"rep": rep.take(some), "to": rep.take(pa.array(part)).take(some), "links": pa.array(links.astype(np.int64)).take(some)})


def _classes(docs: DataFrame, threshold: float, recall: float, block_bytes: int) -> DataFrame:
    """``doc_id, h, least, n_links`` per document; ``least(doc_id, h)`` is the smallest document of its class."""
    bands, rows = choose_bands(threshold, recall)
    signed = stored(signed_docs(docs, bands, rows), "signed")
    one = signed.groupBy("doc_id", "h").agg(F.min(F.struct("k1", "k2", "n_bytes", "bands")).alias("s")).select("doc_id", "h", "s.*")
    copies = one.where("k1 is not null").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "h", "n_bytes", "bands")).alias("r"), F.count("*").alias("copies"))
    reps = stored(copies.select("k1", "k2", "copies", "r.*").withColumn("rep", F.monotonically_increasing_id()), "reps")

    # buckets of several representatives
    hashed = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    met = hashed.groupBy("band", "hash").agg(F.min("rep").alias("low"), F.count("*").alias("n")).where("n > 1")
    met = stored(hashed.join(met.select("band", "hash", "low"), ["band", "hash"]), "met")

    # blocks: a small component is one; in a large one, those with one lowest neighbour stand together
    centre = met.groupBy("rep").agg(F.min("low").alias("centre"))
    component = connected_components(met.select(F.col("rep").alias("u"), F.col("low").alias("v")), small=0)
    placed = centre.join(component.withColumnRenamed("node", "rep"), "rep").join(reps.select("rep", (F.col("n_bytes") + ROW_BYTES).alias("size")), "rep")
    of_centre = placed.groupBy("component", "centre").agg(F.sum("size").alias("near"))
    of_all = of_centre.groupBy("component").agg(F.sum("near").alias("all"))
    parts = lambda c: F.ceil(F.col(c) / F.lit(block_bytes))
    block = (
        F.when(parts("all") == 1, F.xxhash64("component"))
        .when(F.col("near") * 2 >= block_bytes, F.xxhash64("component", "centre", F.pmod(F.xxhash64("rep"), parts("near"))))
        .otherwise(F.xxhash64("component", F.pmod(F.xxhash64("centre"), parts("all"))))
    )
    blocks = stored(placed.join(of_centre, ["component", "centre"]).join(of_all, "component").select("rep", block.alias("block")), "blocks")

    # which blocks to compare: those that a bucket joins
    cells = met.select("rep", "band", "hash").join(blocks, "rep").select("band", "hash", "block").distinct()
    pairs = cells.alias("a").join(cells.select("band", "hash", F.col("block").alias("other")).alias("b"), ["band", "hash"]).where("block <= other").select("block", "other").distinct()
    pairs = stored(pairs, "pairs")
    sides = pairs.select("block", F.struct("block", "other").alias("pair"), F.lit(0).alias("side")).union(pairs.where("block <> other").select("other", F.struct("block", "other"), F.lit(1)))

    texts = docs.select(F.col("doc_id").cast("long"), _text_hash().alias("h"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chosen = blocks.join(reps.select("rep", "copies", "doc_id", "h"), "rep")
    # rows that share a representative's id and hash hold its text
    full = stored(texts.join(chosen, ["doc_id", "h"]).groupBy("rep", "block", "copies").agg(F.min("text").alias("text")), "texts")
    each = full.join(sides, "block").select("pair", "side", "rep", "copies", "text")
    found = stored(each.groupBy("pair").applyInArrow(lambda table: _compare(table, threshold), "rep long, to long, links long"), "found")

    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = connected_components(found.select(F.col("rep").alias("u"), F.col("to").alias("v")), small=0).withColumnRenamed("node", "rep")
    own = F.struct("doc_id", "h")
    least = classes.join(reps.select("rep", own.alias("own")), "rep").groupBy("component").agg(F.min("own").alias("least"))
    known = reps.join(linked, "rep", "left").join(classes.join(least, "component").select("rep", "least"), "rep", "left")
    known = known.select("k1", "k2", F.coalesce("least", own).alias("least"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return one.select("doc_id", "h", "k1", "k2").join(known, ["k1", "k2"], "left").select("doc_id", "h", F.coalesce("least", own).alias("least"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, class_id, n_links`` per row of docs.

    ``n_links`` counts the other documents of similarity ``threshold`` or
    more; ``class_id`` is the smallest doc_id that links lead to. Where unlike
    texts share that id, their classes share it too.
    """
    member = _classes(docs, threshold, recall, block_bytes).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.col("least.doc_id").alias("class_id"), "n_links")
    rows = docs.select(F.col("doc_id").cast("long"), _text_hash().alias("h"))
    return rows.join(member, (F.col("doc_id") == F.col("_d")) & (F.col("h") == F.col("_h")), "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, that with the smallest doc_id; rows without an id stay."""
    member = _classes(docs, threshold, RECALL, BLOCK_BYTES)
    first = member.where(F.col("least") == F.struct("doc_id", "h")).select("doc_id", F.col("h").alias("_h"))
    again = F.row_number().over(Window.partitionBy("doc_id", "_h").orderBy("_h"))
    kept = docs.withColumn("_h", _text_hash()).join(first, ["doc_id", "_h"], "left_semi").withColumn("_again", again).where("_again = 1").drop("_again")
    return kept.select(*docs.columns).union(docs.where("doc_id is null"))


#: jaccard_join in SQL: shared shingles of all pairs that share any, and their closure; for ids that are not repeated.
ORACLE = f"""
with recursive w as (select doc_id, {textkit.words_sql("text")} as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + least({SHINGLE}, len(w)) - 1], ' ') as g
      from w, unnest(range(1, len(w) - least({SHINGLE}, len(w)) + 2)) t(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as met from s a join s b using (g) where a.doc_id <> b.doc_id group by 1, 2),
l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 5 * met >= 4 * (p.n + q.n - met)),
r as (select x, y from l union select r.x, l.y from r join l on r.y = l.x),
f as (select x, min(y) as y from r group by x),
k as (select x, count(*) as k from l group by x)
select doc_id, least(doc_id, coalesce(y, doc_id)) as class_id, coalesce(k, 0) as n_links from w left join f on f.x = doc_id left join k on k.x = doc_id
"""
