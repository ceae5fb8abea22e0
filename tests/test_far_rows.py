"""Queries on grids of many rows, beyond 255 tiles and 1,000 km."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


@pytest.fixture
def far(spark, tmp_path):
    """Rows 0 to 19, and 20 more behind row ``first``."""

    def make(first):
        keys = spark.range(2000).union(spark.range(first * 100, first * 100 + 2000))
        keys.select(F.col("id").alias("o_orderkey"), (F.col("id") * 7 % 1501).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
        spark.read.parquet("/root/testdata/sf0.01/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
        return str(tmp_path)

    return make


def by_sql(name, d):
    with duckdb.connect() as c:
        for t in ("orders", "nation"):
            c.execute(f"create view {t} as select * from '{d}/{t}.parquet/*.parquet'")
        return sorted(c.sql(entry.oracle_sql()[name]).fetchall())


def test_tiles_have_names_of_their_own(spark, far):
    d = far(256 * 50)
    got = entry.queries()["best_overlap_join"](spark, d).select("tile", "label", "CNTYFIPS", "n_pixels").collect()
    assert sorted(map(tuple, got)) == by_sql("best_overlap_join", d)


def test_strips_reach_the_last_row(spark, far):
    d = far(40_000)
    got = entry.queries()["polygon_overlap"](spark, d).select("label", "zone", "area").collect()
    assert sorted(map(tuple, got)) == by_sql("polygon_overlap", d)
