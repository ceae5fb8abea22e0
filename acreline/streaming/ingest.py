"""New pixel files to region tables, tile by tile, with Structured Streaming.

Batch runs resume by the tiles that are finished (``tiles.pending``); a stream
does the same continuously. A batch's tiles go to folders of their own that
are overwritten as a whole, so a batch that is tried again changes nothing. A
tile that another batch has brought already is an error, as half of it would
be lost.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acreline.plans.pipeline import Params, polygonize
from acreline.runtime import stored


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, params: Params) -> StreamingQuery:
    """Watches ``source`` for Parquet stacks (``tile, pix, r, c, cdl``), each tile in one file."""

    def batch(rows: DataFrame, number: int) -> None:
        made = stored(polygonize(rows, params).withColumn("batch", F.lit(number).cast("long")), "ingested")
        try:
            there = spark.read.parquet(target).where(F.col("batch") != number)
        except AnalysisException:
            there = None  # nothing is there yet
        twice = there and there.join(made.select("tile").distinct(), "tile", "left_semi").select("tile").first()
        if twice:
            raise ValueError(f"tile {twice['tile']} came in two batches; bring a tile in one file")
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(target)

    stream = spark.readStream.schema("tile string, pix long, r long, c long, cdl array<int>").parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
