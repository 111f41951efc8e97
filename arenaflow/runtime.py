"""Helpers that every operator shares: table access, the shared folder, size checks."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when its counted rows stay below this.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where the session names none, a temporary one if driver and executors are one process, as in tests; on a cluster that is an error, for its machines share no temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    made = tempfile.mkdtemp(prefix="arenaflow-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/arenaflow-{name}-{uuid.uuid4().hex}"
    atexit.register(_drop, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a parquet table in the shared folder and read it back.

    Cuts the lineage, survives lost executors and keeps recomputation from
    seeing other range boundaries. An empty df gives an empty table. The table
    is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(jvm, conf, path: str) -> None:
    """Deletes the folder in whatever file system holds it; at the driver's end the JVM may be gone already."""
    try:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    except Exception:  # noqa: BLE001
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def fits_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most `most` rows; reads no more than one row beyond."""
    return df.limit(most + 1).count() <= most


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def stripped(c: str | Column) -> Column:
    """Trimmed of spaces and tabs; blank becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.regexp_replace(c, r"^[ \t]+|[ \t]+$", "")
    return F.when(t != "", t)
