"""Sharding by a Feistel permutation over global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_hash, tidy
from .feistel import key_of, permute


def number_rows(df: DataFrame, by: list[str], name: str = "row", rows_per_bucket: int = 65_536) -> tuple[DataFrame, int]:
    """Adds gapless row numbers from 0 and returns the number of rows.

    A row's number depends on the rows alone, not on files or partitions: rows are ordered by (bucket, two hashes of
    the whole row, ``by``), where the bucket is a hash range. Buckets are numbered on their own and shifted by the sizes of
    those before them, so no task sees more than a bucket. Rows equal in every column share a bucket and take
    neighbouring numbers; nulls are ordinary values.
    """
    df = tidy(df, by, [name, "_h", "_h2", "_b", "_n", "_off"])
    total = df.count()
    buckets = max(64, -(-total // rows_per_bucket))
    rows = df.withColumn("_h", row_hash(df)).withColumn("_h2", row_hash(df, 1)).withColumn("_b", F.pmod("_h", F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_b").orderBy("_h", "_h2", *by)
    out = rows.withColumn("_n", F.row_number().over(inside)).join(offsets, "_b")
    return out.withColumn(name, F.col("_off") + F.col("_n") - 1).drop("_h", "_h2", "_b", "_n", "_off"), total


def shard_rows(df: DataFrame, n_shards: int, by: list[str], seed: int = 0) -> DataFrame:
    """Deals rows to shards in a reproducible shuffle: adds ``shard`` (int) and ``slot`` (long, gapless from 0 in a shard).

    Row numbers 0..N-1 are permuted by a keyed Feistel network with cycle walking; position p goes to shard p mod
    n_shards, slot p div n_shards. So shard sizes differ by one at most, whatever the keys, and both are computable
    from (row number, N, seed) without looking at other rows. Nulls in any column, empty and long texts, repeated rows
    and ties need no care: they only set a row's number. An empty table gives an empty result; other columns pass
    through, and ones named ``shard`` or ``slot`` are replaced.
    """
    rows, total = number_rows(tidy(df, by, ["shard", "slot", "_p"]), by, "_row")
    key = key_of(seed, n_shards)

    @F.pandas_udf("long")
    def position(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(np.uint64), max(total, 1), key).astype(np.int64))

    return (
        rows.withColumn("_p", position("_row"))
        .withColumn("shard", F.pmod("_p", F.lit(n_shards)).cast("int"))
        .withColumn("slot", F.expr(f"_p div {n_shards}"))
        .drop("_row", "_p")
    )
