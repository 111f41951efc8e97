"""Exact quantiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float, name: str, margin: float = 0.002) -> DataFrame:
    """(keys, name): the quantile p of the non-null values per key, interpolated between ranks as SQL's quantile_cont does. Keys without values do not come out.

    A sketch of bounded size brackets the rank of every key; the values below
    the bracket are only counted, and only those inside, a share of about
    2 * margin, are put in order, equal ones as one row. The sketch's rank is off
    by a tenth of the margin at most, so the bracket holds the rank; keys of so
    few values that a margin is no whole rank have all of them inside.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, F.col(value).cast("double").alias("v"))
    probs = F.array(F.lit(max(0.0, p - margin)), F.lit(min(1.0, p + margin)))
    bracket = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile_approx("v", probs, round(10 / margin)).alias("q"), F.min("v").alias("least"), F.max("v").alias("most"))
    few = F.col("n") * margin < 4
    bracket = bracket.select(*[F.col(k).alias(f"b_{k}") for k in keys], "n", F.when(few, F.col("least")).otherwise(F.col("q")[0]).alias("lo"), F.when(few, F.col("most")).otherwise(F.col("q")[1]).alias("hi"))
    # Keys compare null-safe: a null key is a group.
    same = [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in keys]
    # Below the bracket one row per key, inside it one per value; both combine before they shuffle.
    counts = rows.join(bracket, same).where("v <= hi").groupBy(*keys, "n", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("at")).agg(F.count("*").alias("c"))
    order = Window.partitionBy(*keys).orderBy(F.col("at").asc_nulls_first())
    upto = counts.withColumn("upto", F.sum("c").over(order)).withColumn("before", F.col("upto") - F.col("c")).where("at IS NOT NULL")
    rank = F.lit(p) * (F.col("n") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    at_rank = lambda k: F.max(F.when((F.col("before") <= k) & (k < F.col("upto")), F.col("at")))
    return upto.groupBy(*keys).agg(at_rank(low).alias("a"), at_rank(high).alias("z"), F.first(rank - low).alias("w")).select(*keys, (F.col("a") + (F.col("z") - F.col("a")) * F.col("w")).alias(name))
