"""Cutting lineage: tables written to the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where one process does all the work (master local) a temporary one may
    stand in for it; a cluster without the setting is refused, since its executors would write to folders of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='taxaflow-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def run_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one."""
    return f"{shared_dir(spark)}/taxaflow-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the run's folder: later plans start from it, and lost executors don't take it with them.

    The table stays until ``clean_run`` is called, since results that read it are lazy.
    """
    path = f"{run_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_run(spark: SparkSession) -> None:
    """Deletes all tables of this run; to be called when its results have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
