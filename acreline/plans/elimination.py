"""Times the elimination of slivers on windows of growing size."""

from __future__ import annotations

import json
import subprocess
import sys
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.operators import combine, regions
from acreline.operators.evaluate import quartiles
from acreline.runtime import stored


def runs(stack: DataFrame, n_years: int, sizes: tuple[int, ...], repeats: int = 5, thresholds: tuple[float, ...] = regions.THRESHOLDS) -> Iterator[dict]:
    """A record per size and repeat: seconds, regions before and after, their area, and the driver's peak memory so far.

    The window of a size is the upper left ``size`` rows and columns of the
    stack. Region and edge tables are stored first, so that only elimination
    is timed.
    """
    for size in sizes:
        px = combine.retained(combine.keyed(stack.where((F.col("r") < size) & (F.col("c") < size)), n_years))
        labels = stored(regions.components(px), "labels")
        table, edges = stored(regions.region_table(labels), "regions"), stored(regions.adjacency(labels), "edges")
        before = table.count()
        for k in range(repeats):
            began = time.time()
            merged = regions.eliminate(table, edges, thresholds)[0]
            after = merged.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_pixels"), F.lit(0)).alias("pixels")).first()
            yield {"size": size, "repeat": k, "seconds": round(time.time() - began, 3), "regions": before, "left": after["n"], "area_sqm": after["pixels"] * 900.0, "peak_mb": peak_mb(stack.sparkSession)}


def peak_mb(spark: SparkSession) -> float | None:
    """The most memory that the driver's process held, where the system tells."""
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    try:
        with open(f"/proc/{pid}/status") as f:
            return next(int(line.split()[1]) / 1024 for line in f if line.startswith("VmHWM"))
    except (OSError, StopIteration):
        return None


def fresh_runs(source: str, sizes: tuple[int, ...], repeats: int = 5) -> Iterator[dict]:
    """As ``runs``, but each in a process of its own, with ``peak_mb`` of its driver."""
    for size in sizes:
        for k in range(repeats):
            one = [sys.executable, "-m", "acreline.cli", "bench-eliminate", source, "--sizes", str(size), "--repeats", "1"]
            lines = [json.loads(x) for x in subprocess.run(one, check=True, capture_output=True, text=True).stdout.splitlines() if x.startswith("{")]
            yield next(x for x in lines if "regions" in x) | {"repeat": k}


def summary(spark: SparkSession, records: list[dict]) -> list[dict]:
    """Median, quartiles and range of the seconds per size."""
    df = spark.createDataFrame(records)
    return [{"size": s, **quartiles(df.where(F.col("size") == s), "seconds").first().asDict()} for s in sorted({r["size"] for r in records})]
