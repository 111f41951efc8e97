"""Writes without an engine for updates: upserts, reloads by key, updates from a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize


def upsert(old: DataFrame, new: DataFrame, keys: list[str], seq: Column) -> DataFrame:
    """old with the rows of new in place of those with the same keys; of new rows with the same keys the one with the greatest seq counts. Columns that new lacks become null."""
    one = new.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(seq.desc()))).where("_rn = 1").drop("_rn")
    return old.join(one.select(*keys), keys, "left_anti").unionByName(one.select(*[F.col(c) if c in one.columns else F.lit(None).cast(t).alias(c) for c, t in old.dtypes]))


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without any row whose keys occur in new, and all rows of new: a repeatable reload."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def update_from(old: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """old with the non-null values of updates (unique keys) in the columns."""
    u = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return old.join(u, keys, "left").select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in old.columns])


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces in the table at path only the partitions that df has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Adds the rows to the table at path, partitioned by the columns where they are given."""
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def numbered(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with place, 1, 2, ... in the order of all rows, which must be a total one.

    Rows are sorted by range into partitions that are written once, so that their
    borders stay; each partition counts its own rows, and the counts before it
    are its offset. No task holds more than a partition.
    """
    ranged = df.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "numbered")
    # One row per partition.
    before = ranged.groupBy("part").count().withColumn("before", F.sum("count").over(Window.orderBy("part")) - F.col("count")).select("part", "before")
    own = ranged.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    return own.join(before, "part").withColumn("place", F.col("place") + F.col("before")).drop("part", "before")
