"""Structured Streaming: reads that arrive in a folder, counted by sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "read_id string, seq string, qual string, barcode string, ts timestamp"


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """Reads as parquet files that appear in a folder."""
    return spark.readStream.schema(SCHEMA).parquet(path)


def counts_by_sample(reads: DataFrame, sample_map: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Reads by sample and time window; the map is static, reads later than ``late`` are left out."""
    own = reads.withWatermark("ts", late).join(sample_map.select("barcode", "sample_id"), "barcode")
    return own.groupBy(F.window("ts", window).alias("w"), "sample_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "sample_id", "n")


def to_folder(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes closed windows as parquet, exactly once."""
    return counts.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
