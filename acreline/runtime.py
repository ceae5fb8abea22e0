"""Shared storage and lineage cuts.

Iterative plans need a cut now and then, or the plan grows with every round.
The cut is always a written table in the folder that all executors share, so
a lost executor costs a re-read and never a failed job.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset a temporary folder stands in, but only for a master
    that runs in this one process; on a cluster that would be a folder the
    executors cannot see, so it is an error there.
    """
    sc = spark.sparkContext
    if path := sc.getConf().get("spark.checkpoint.dir"):
        return path.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="acreline-")
    return _LOCAL[sc.applicationId]


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, under this application's id."""
    return f"{shared_dir(spark)}/acreline/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Delete everything this application stored; call once its results are consumed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/acreline/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
