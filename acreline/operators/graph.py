"""Connected components of an edge table.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). Each round is a minimum per node
with map-side combine and an equi-join; nothing is gathered on the driver but
one row of convergence figures. The edge table is written to the shared
folder after every round. A graph of at most ``small`` edges, counted first,
is settled in one task instead: the answer is the same, the rounds are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.operators.blocks import roots
from acreline.runtime import stored

MAX_ROUNDS = 60
SMALL_EDGES = 200_000


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _ranks(column: pa.Array) -> np.ndarray:
    """Numbers in the order of the values; of a struct by its fields in turn."""
    if not pa.types.is_struct(column.type):
        return np.unique(column.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    parts = [_ranks(column.field(i)) for i in range(column.type.num_fields)]
    rank = parts[0]
    for part in parts[1:]:
        rank = np.unique(rank * (int(part.max(initial=0)) + 1) + part, return_inverse=True)[1]
    return rank


def _in_one_task(e: DataFrame) -> DataFrame:
    kind = e.schema["u"].dataType.simpleString()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (got := [b for b in batches if len(b)]):
            return
        table = pa.Table.from_batches(got).combine_chunks()
        ends = pa.concat_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns])
        _, example, node = np.unique(_ranks(ends), return_index=True, return_inverse=True)
        names, half = ends.take(pa.array(example)), len(table)
        yield pa.RecordBatch.from_arrays([names, names.take(pa.array(roots(len(example), node[:half], node[half:])))], ["node", "component"])

    return e.coalesce(1).mapInArrow(settle, f"node {kind}, component {kind}")


def connected_components(edges: DataFrame, small: int = SMALL_EDGES) -> DataFrame:
    """``edges(u, v)`` of any orderable type, undirected -> ``(node, component)``.

    ``component`` is the smallest node of the component. Nodes without an edge
    to another node do not appear; null ends and self loops are ignored; an
    empty table gives an empty table.
    """
    e = stored(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if small and e.count() <= small:
        return _in_one_task(e)
    before = None
    for _ in range(MAX_ROUNDS):
        e = stored(_small_star(_large_star(e)), "stars")
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
