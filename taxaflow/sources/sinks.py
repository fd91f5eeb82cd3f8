"""Writers of text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with header; arrays are joined by commas, whole doubles lose their .0."""
    cells = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), ",")
        elif kind in ("double", "float"):
            c = F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))
        cells.append(c.alias(name))
    df.select(*cells).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_lines(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)


def fasta_lines(seqs: DataFrame, key: str = "id") -> DataFrame:
    return seqs.select(F.concat(F.lit(">"), F.col(key), F.lit("\n"), F.col("seq")).alias("value"))


def fastq_lines(reads: DataFrame) -> DataFrame:
    return reads.select(F.concat(F.lit("@"), "header", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))


def join_parts(spark: SparkSession, folder: str, path: str) -> None:
    """One new file of a folder's parts in order of their names, by the stores' own streams, a small buffer at a time."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    source, target = hadoop.fs.Path(folder), hadoop.fs.Path(path)
    fs = source.getFileSystem(conf)
    out = target.getFileSystem(conf).create(target, False)
    try:
        for p in sorted((f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName()):
            part = fs.open(p)
            try:
                hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            finally:
                part.close()
    finally:
        out.close()


def write_by_domain(table: DataFrame, path: str) -> None:
    """One folder for each domain."""
    table.write.mode("overwrite").partitionBy("domain").parquet(path)
