"""Queries over lists, names and caches, and correlations, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaflow.functions.staging import materialize
from taxaflow.operators import hits, mapping, reads, report, stats
from taxaflow.plans import adapters as A
from taxaflow.plans.adapters import sql
from taxaflow.plans.tables import MEANS, RANK, phase_means, rounded
from taxaflow.sources import text

Q, O = {}, {}  # noqa: E741


def query(name: str, oracle: str):
    def keep(f):
        Q[name], O[name] = f, oracle
        return f

    return keep


@query("barcode_fasta", sql("SELECT '>S' || sample_id || chr(10) || barcode AS value FROM sample_map WHERE CAST(sample_id AS INT) % 2 = 0", "sample_map"))
def barcode_fasta(s, d):
    start = F.when(F.col("sample_id").cast("int") % 2 == 0, "S").otherwise("#S")
    return text.barcode_fasta(A.sample_map(s, d).withColumn("sample_id", F.concat(start, "sample_id")))


@query("abundant_in_sets", sql("""
sizes AS (SELECT treatment, count(*) AS n FROM sample_map GROUP BY 1)
SELECT treatment AS set, tu_id, round(sum(f.n) / any_value(sizes.n), 9) AS mean FROM feature_long f JOIN sample_map USING (sample_id) JOIN sizes USING (treatment) GROUP BY 1, 2 HAVING sum(f.n) / any_value(sizes.n) >= 4.0""", "feature_long", "sample_map"))  # fmt: skip
def abundant_in_sets(s, d):
    sets = A.sample_map(s, d).select("sample_id", F.col("treatment").alias("set"))
    return rounded(stats.abundant_in_sets(A.feature_long(s, d), sets, 4.0), "mean")


@query("labelled_cells", """
WITH l AS (SELECT 'Supplier#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS id FROM supplier WHERE s_suppkey % 3 = 0),
t AS (SELECT CAST(c_custkey AS VARCHAR) AS custkey, 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS a, 'Supplier#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') AS b FROM customer)
SELECT custkey, CASE WHEN a IN (SELECT id FROM l) THEN 'PH-' || a ELSE a END AS a, CASE WHEN b IN (SELECT id FROM l) THEN 'PH-' || b ELSE b END AS b FROM t""")
def labelled_cells(s, d):
    name = lambda c: F.concat(F.lit("Supplier#"), F.lpad(c.cast("string"), 9, "0"))
    labels = A.read(s, d, "supplier").where("s_suppkey % 3 = 0").select(name(F.col("s_suppkey")).alias("id"), F.lit("PH").alias("label"))
    table = A.read(s, d, "customer").select(F.col("c_custkey").cast("string").alias("custkey"), name(F.col("c_custkey")).alias("a"), name(F.col("c_custkey") + 1).alias("b"))
    return report.label_cells(table, labels)


@query("records_by_id", sql("SELECT read_id, md5(seq) AS digest FROM reads WHERE ord IN (SELECT p_partkey FROM part)", "reads"))
def records_by_id(s, d):
    ids = A.read(s, d, "part").select(F.col("p_partkey").cast("string"))
    return reads.only_ids(A.reads(s, d), ids, "read_id").select("read_id", F.md5("seq").alias("digest"))


@query("sorted_ids", "SELECT id, row_number() OVER (ORDER BY id) AS place FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem)")
def sorted_ids(s, d):
    return reads.sorted_ids(A.read(s, d, "lineitem").select(F.col("l_partkey").cast("string").alias("id")))


@query("renamed_headers", """SELECT 'Asv' || p_partkey AS "#OTU ID", p_name AS taxonomy, p_size FROM part""")
def renamed_headers(s, d):
    table = A.read(s, d, "part").select(F.concat(F.lit("Zotu"), F.col("p_partkey").cast("string")).alias("Feature ID"), F.col("p_name").alias("Taxon"), "p_size")
    return report.rename_headers(table.withColumn("Feature ID", report.rename_ids(F.col("Feature ID"))))


@query("taxonomy_cache", sql("SELECT taxid, array_to_string(lineage, ';') AS lineage FROM taxid_lineages WHERE CAST(taxid AS INT) % 5 <> 0", "taxid_lineages"))
def taxonomy_cache(s, d):
    known = A.taxid_lineages(s, d)
    wanted = known.select("taxid").where("cast(taxid as int) % 5 <> 0")
    got, _ = text.through_cache(known.where("cast(taxid as int) % 2 = 0"), wanted, lambda missing: known.join(missing, "taxid", "left_semi"))
    return got.select("taxid", F.array_join("lineage", ";").alias("lineage"))


@query("rendered_vectors", "SELECT l_orderkey, string_agg(printf('%g', CAST(l_extendedprice AS DOUBLE) * CAST(0.12345678 AS DOUBLE) * pow(CAST(10 AS DOUBLE), l_linenumber - 4)), ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS vector FROM lineitem GROUP BY 1")
def rendered_vectors(s, d):
    value = (F.col("l_extendedprice").cast("double") * 0.12345678 * F.pow(F.lit(10.0), F.col("l_linenumber") - 4)).alias("v")
    rows = A.read(s, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", value).alias("x"))
    vectors = rows.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x.v).alias("v"))
    return vectors.select("l_orderkey", report.rendered(F.col("v")).alias("vector"))


@query("deepened_hits", sql("""
first AS (SELECT * FROM hits WHERE hit_ord <= 2),
fs AS (SELECT qseqid, sseqid, arg_min(pident, hit_ord) AS pident, arg_min(mismatch, hit_ord) AS mismatch FROM first GROUP BY 1, 2),
ne AS (SELECT qseqid FROM fs GROUP BY 1 HAVING count(DISTINCT pident) = 1 OR count(DISTINCT mismatch) = 1),
need AS (SELECT qseqid FROM queries_of_hits WHERE size >= 0.01 * (SELECT max(size) FROM queries_of_hits) AND qseqid IN (SELECT qseqid FROM ne))
SELECT qseqid, hit_ord, count(*) AS times FROM (SELECT qseqid, hit_ord FROM first UNION ALL SELECT qseqid, hit_ord FROM hits WHERE qseqid IN (SELECT qseqid FROM need)) GROUP BY 1, 2""", "hits", "queries_of_hits"))  # fmt: skip
def deepened_hits(s, d):
    # Ordered once and written down: the first search, the depth check and the deeper search all take them from there.
    h = materialize(A.hits(s, d).select("qseqid", "sseqid", "pident", "mismatch", "hit_ord"), "hits")
    every, _ = hits.deepen(h.where("hit_ord <= 2"), A.queries_of_hits(s, d), lambda need, _: h.join(need.select("qseqid"), "qseqid", "left_semi"))
    return every.groupBy("qseqid", "hit_ord").agg(F.count(F.lit(1)).alias("times"))


@query("map_names_to_units", """
WITH u AS (SELECT CAST(s_suppkey AS VARCHAR) AS tu_id, 'Customer#' || lpad(CAST(s_suppkey * 15 AS VARCHAR), 9, '0') AS unit, s_suppkey AS ord FROM supplier),
p AS (SELECT c_custkey, tu_id, ord, 1 - levenshtein(c_name, unit) / greatest(length(c_name), length(unit)) AS identity FROM customer, u),
b AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY identity DESC, ord) AS i FROM p WHERE identity >= 0.94)
SELECT CAST(c_custkey AS VARCHAR) AS read_id, tu_id, round(identity, 9) AS identity FROM b WHERE i = 1""")
def map_names_to_units(s, d):
    names = A.read(s, d, "customer").select(F.col("c_custkey").cast("string").alias("read_id"), F.col("c_name").alias("seq"), F.col("c_mktsegment").alias("sample_id"))
    key = F.col("s_suppkey")
    units = A.read(s, d, "supplier").select(key.cast("string").alias("id"), F.concat(F.lit("Customer#"), F.lpad((key * 15).cast("string"), 9, "0")).alias("seq"), key.alias("ord"))
    return rounded(mapping.map_reads(names, units, 0.94).select("read_id", "tu_id", "identity"), "identity")


CHANGES = MEANS + """,
f AS (SELECT a.tu_id, a.grp, b.mean AS abundance, a.mean / b.mean AS change FROM m a JOIN m b ON a.tu_id = b.tu_id AND a.grp = b.grp AND a.phase = 'after' AND b.phase = 'before'),
e AS (SELECT f.*, value FROM f JOIN (SELECT grp, avg(value) AS value FROM sample_map GROUP BY 1) USING (grp)),
"""


def changes(s, d):
    return stats.correlate_with_change(phase_means(s, d), "phase", "grp", "before", "before", "after")


@query("fold_change_rho", sql(CHANGES.lstrip() + f"""
r AS (SELECT tu_id, {RANK.format(k='tu_id', v='abundance')} AS x, {RANK.format(k='tu_id', v='change')} AS y FROM e)
SELECT tu_id, count(*) AS n, round(corr(x, y), 9) + 0 AS rho FROM r GROUP BY 1""", "feature_long", "sample_map"))
def fold_change_rho(s, d):
    return rounded(changes(s, d).select("tu_id", "n", "rho"), "rho").withColumn("rho", F.col("rho") + 0.0)  # no zero with a sign


@query("external_rho", sql(CHANGES.lstrip() + f"""
r AS (SELECT tu_id, {RANK.format(k='tu_id', v='value')} AS x, {RANK.format(k='tu_id', v='change')} AS y FROM e)
SELECT tu_id, count(*) AS n, round(corr(x, y), 9) + 0 AS rho FROM r GROUP BY 1""", "feature_long", "sample_map"))
def external_rho(s, d):
    external = A.sample_map(s, d).groupBy(F.col("grp").alias("name")).agg(F.avg("value").alias("value"))
    out = stats.correlate_with_external(changes(s, d).select("tu_id", "groups", "changes"), external)
    return rounded(out.select("tu_id", "n", "rho"), "rho").withColumn("rho", F.col("rho") + 0.0)
