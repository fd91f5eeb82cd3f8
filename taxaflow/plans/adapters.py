"""Domain-typed views of the general tables, and the same views as SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Bytes that a task reads of a file and of a shuffle at most, as far as the shuffle has partitions enough.
TASK_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, in tasks that keep their size when it grows: rows of numbers take 20 times their shuffled bytes in memory.

    Only settings that are larger (smaller, for the number of partitions) are changed; adaptive execution joins partitions that are small.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        if _bytes(spark, spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, f"{TASK_BYTES}b")
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    some, least = size * 8 // TASK_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = int(spark.conf.get(first, None) or least)
    if max(some, least) > held:
        spark.conf.set(first, max(some, least))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def text(column: str):
    return F.col(column).cast("string")


def feature_long(spark, d) -> DataFrame:
    """Keys are grouped as numbers and named afterwards, which takes less memory."""
    cells = read(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("n"))
    return cells.select(text("l_partkey").alias("tu_id"), text("l_suppkey").alias("sample_id"), "n")


def feature_samples(spark, d) -> DataFrame:
    """The samples of ``feature_long``, without its cells."""
    return read(spark, d, "lineitem").select(text("l_suppkey").alias("sample_id")).distinct()


def feature_small(spark, d) -> DataFrame:
    return read(spark, d, "events").groupBy(text("user_id").alias("tu_id"), F.col("event_type").alias("sample_id")).agg(F.count(F.lit(1)).alias("n"))


def tu_taxonomy(spark, d) -> DataFrame:
    lineage = F.array(F.concat(F.lit("d__"), "p_type"), F.concat(F.lit("k__"), "p_brand"), F.concat(F.lit("p__"), "p_name"))
    return read(spark, d, "part").select(text("p_partkey").alias("tu_id"), lineage.alias("lineage"), F.array_join(lineage, ";").alias("taxonomy"))


def sample_map(spark, d) -> DataFrame:
    s, n, r = read(spark, d, "supplier"), read(spark, d, "nation"), read(spark, d, "region")
    both = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return both.select(text("s_suppkey").alias("sample_id"), F.col("r_name").alias("grp"), F.col("n_name").alias("treatment"), F.col("s_acctbal").alias("value"), F.lpad(text("s_suppkey"), 6, "0").alias("barcode"))


def hits(spark, d) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    part = read(spark, d, "part").select("p_partkey", "p_name")
    two = F.array(text("l_suppkey"), (F.col("l_suppkey") + 1).cast("string"))
    return (
        read(spark, d, "lineitem").withColumn("hit_ord", F.row_number().over(order)).join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            text("l_orderkey").alias("qseqid"), F.concat(F.lit("gb|"), text("l_partkey"), F.lit("|")).alias("sseqid"), F.col("l_discount").alias("pident"),
            F.col("l_quantity").cast("int").alias("length"), F.col("l_linenumber").alias("mismatch"), F.col("l_tax").alias("evalue"),
            F.floor(F.col("l_quantity") / 10).cast("double").alias("bitscore"), F.when(F.col("l_linenumber") % 7 == 0, two).otherwise(F.array(text("l_suppkey"))).alias("staxids"),
            F.col("p_name").alias("stitle"), (F.col("l_tax") * 100).alias("qcovs"), F.col("hit_ord").cast("bigint").alias("hit_ord"))
    )


def queries_of_hits(spark, d) -> DataFrame:
    return read(spark, d, "orders").select(text("o_orderkey").alias("qseqid"), F.floor("o_totalprice").cast("bigint").alias("size"), F.col("o_orderkey").alias("q_ord"))


def taxid_lineages(spark, d) -> DataFrame:
    """A lineage of three ranks for each supplier as taxid."""
    m = sample_map(spark, d)
    lineage = F.array(F.concat(F.lit("d__"), "grp"), F.concat(F.lit("k__"), "treatment"), F.concat(F.lit("p__S"), "sample_id"))
    return m.select(F.col("sample_id").alias("taxid"), lineage.alias("lineage"))


def reads(spark, d, first: int | None = None) -> DataFrame:
    """Whole texts (or their ``first`` characters) as sequences; white space and signs are quality characters like any other."""
    text_ = F.coalesce("text", F.lit(""))
    seq = F.regexp_replace(text_ if first is None else F.substring(text_, 1, first), r"[^\x00-\x7F]", "?")
    return read(spark, d, "documents").select(text("doc_id").alias("read_id"), seq.alias("seq"), seq.alias("qual"), F.col("source").alias("sample_id"), F.col("lang").alias("grp"), F.col("doc_id").alias("ord"))


def barcoded(spark, d) -> DataFrame:
    return read(spark, d, "lineitem").select(text("l_orderkey").alias("read_id"), F.lpad(text("l_partkey"), 6, "0").alias("barcode"))


def taxid_lists(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept, environmental and rejected taxids; they overlap."""
    t = read(spark, d, "supplier").select(F.col("s_suppkey").alias("taxid"))
    return t.where("taxid % 4 = 0"), t.where("taxid % 6 = 1"), t.where("taxid % 5 = 2")


SQL = {
    "feature_long": "SELECT CAST(l_partkey AS VARCHAR) AS tu_id, CAST(l_suppkey AS VARCHAR) AS sample_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2",
    "feature_small": "SELECT CAST(user_id AS VARCHAR) AS tu_id, event_type AS sample_id, count(*) AS n FROM events GROUP BY 1, 2",
    "tu_taxonomy": "SELECT CAST(p_partkey AS VARCHAR) AS tu_id, ['d__' || p_type, 'k__' || p_brand, 'p__' || p_name] AS lineage, 'd__' || p_type || ';k__' || p_brand || ';p__' || p_name AS taxonomy FROM part",
    "sample_map": "SELECT CAST(s_suppkey AS VARCHAR) AS sample_id, r_name AS grp, n_name AS treatment, s_acctbal AS value, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS barcode FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "hits": """SELECT CAST(l_orderkey AS VARCHAR) AS qseqid, 'gb|' || l_partkey || '|' AS sseqid, l_discount AS pident, l_linenumber AS mismatch, floor(l_quantity / 10) AS bitscore,
        CASE WHEN l_linenumber % 7 = 0 THEN [CAST(l_suppkey AS VARCHAR), CAST(l_suppkey + 1 AS VARCHAR)] ELSE [CAST(l_suppkey AS VARCHAR)] END AS staxids, p_name AS stitle, l_tax * 100 AS qcovs,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS hit_ord FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "queries_of_hits": "SELECT CAST(o_orderkey AS VARCHAR) AS qseqid, CAST(floor(o_totalprice) AS BIGINT) AS size FROM orders",
    "taxid_lineages": "SELECT CAST(s_suppkey AS VARCHAR) AS taxid, ['d__' || r_name, 'k__' || n_name, 'p__S' || s_suppkey] AS lineage FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "reads": "SELECT CAST(doc_id AS VARCHAR) AS read_id, regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]', '?', 'g') AS seq, source AS sample_id, lang AS grp, doc_id AS ord FROM documents",
    "barcoded": "SELECT CAST(l_orderkey AS VARCHAR) AS read_id, lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS barcode FROM lineitem",
}


def sql(body: str, *names: str) -> str:
    """The views by those names and the query over them."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + ("\n" if body.lstrip().startswith("SELECT") else ",\n") + body
