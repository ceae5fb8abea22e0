"""Times the raster half on one tile of BENCH_PIXELS pixels (default 1000000); prints one JSON line.

Fields of some 600 pixels with one pixel in 50 astray, eight years, on local[BENCH_CPUS].
"""

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stack(spark: SparkSession, side: int) -> DataFrame:
    """One square tile; a field is 24 x 25 pixels, its classes go by a hash of its place."""
    g = spark.range(side * side, numPartitions=32).select(F.col("id").alias("pix"), F.floor(F.col("id") / side).alias("r"), (F.col("id") % side).alias("c"))
    field = F.xxhash64(F.floor(F.col("r") / 24), F.floor(F.col("c") / 25))
    astray = F.pmod(F.xxhash64("pix"), F.lit(50)) == 0
    classes = F.array(*map(F.lit, (1, 5, 24, 36, 152, 176)))
    year = lambda y: F.when(astray, F.lit(37)).otherwise(F.element_at(classes, (F.pmod(field + y * F.pmod(field, F.lit(3)), F.lit(6)) + 1).cast("int")))
    return g.select(F.lit("A0").alias("tile"), "pix", "r", "c", F.array(*map(year, range(8))).alias("cdl"))


def main() -> None:
    pixels, cpus = int(os.environ.get("BENCH_PIXELS", "1000000")), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench-pixels").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from acreline.operators import combine, denoise, regions
    from acreline.plans import pipeline
    from acreline.runtime import stored

    side, seconds = int(pixels**0.5), {}

    def timed(name: str, made: DataFrame) -> DataFrame:
        began = time.time()
        out = stored(made, name)
        seconds[name] = round(time.time() - began, 1)
        return out

    rows = timed("stack", stack(spark, side))
    timed("noise", denoise.heal_noise(rows, 2, "cdl"))
    began = time.time()
    labels = stored(regions.components(combine.retained(combine.keyed(rows, 8)).drop("cdl", "keys", "attr")), "labels")
    seconds["components"] = round(time.time() - began, 1)
    timed("adjacency", regions.adjacency(labels))
    began = time.time()
    shapes = pipeline.polygonize(rows, pipeline.Params())
    n = stored(shapes, "shapes").count()
    seconds["polygonize"] = round(time.time() - began, 1)
    print(json.dumps({"pixels": side * side, "cpus": int(cpus), "polygons": n, "seconds": seconds, "pixels_a_second": round(side * side / seconds["polygonize"])}))
    spark.stop()


if __name__ == "__main__":
    main()
