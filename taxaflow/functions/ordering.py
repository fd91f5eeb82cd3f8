"""Numbering and running minima over a whole table without moving it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.staging import materialize


def _sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partitioned and sorted; written, so that every reader sees the same partitions."""
    part = df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    return materialize(part, "sorted")


def _number(part: DataFrame, name: str) -> DataFrame:
    sizes = part.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33)
    return part.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_off") + inside + 1).drop("_off")


def row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds gapless numbers from 1 in that order, which should be total."""
    return _number(_sorted(df, order), name).drop("_part", "_at")


def adjust_bh(df: DataFrame, p: str = "p", name: str = "p_adj") -> DataFrame:
    """Adds Benjamini-Hochberg adjusted p-values; null and NaN p-values stay null and don't count.

    The adjusted value is the least p * m / rank at this rank or above: partitions of the sorted table take their own
    running minimum and that of the partitions after them. Rows of one p-value, which may be many, are spread over
    partitions by their hash; all of them get the value of the last rank among them.
    """
    usable = F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double"))
    ranked = _number(_sorted(df.where(usable), [F.col(p).asc(), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]), "_rank")
    total = ranked.agg(F.count(F.lit(1)).alias("_m"))
    raw = ranked.crossJoin(F.broadcast(total)).withColumn("_raw", F.col(p) * F.col("_m") / F.col("_rank"))
    after = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    later = raw.groupBy("_part").agg(F.min("_raw").alias("_least")).select("_part", F.min("_least").over(after).alias("_later"))
    here = Window.partitionBy("_part").orderBy(F.desc("_rank"))
    out = raw.join(F.broadcast(later), "_part").withColumn(name, F.least(F.lit(1.0), F.min("_raw").over(here), F.col("_later")))
    out = out.drop("_part", "_at", "_rank", "_m", "_raw", "_later")
    return out.unionByName(df.where(~F.coalesce(usable, F.lit(False))).withColumn(name, F.lit(None).cast("double")))
