"""Queries over search hits, lineages and keep/reject decisions, with their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from taxaflow.operators import categorize, hits, taxonomy
from taxaflow.plans import adapters as A
from taxaflow.plans.adapters import sql
from taxaflow.sources import text

Q, O = {}, {}  # noqa: E741


def query(name: str, oracle: str | None = None):
    def keep(f):
        Q[name] = f
        if oracle:
            O[name] = oracle
        return f

    return keep


def env_taxids(s, d):
    return A.read(s, d, "supplier").where("s_suppkey % 9 = 0").select(F.col("s_suppkey").cast("string").alias("taxid"))


@query("env_hit_filter", sql("SELECT qseqid, hit_ord, sseqid FROM hits WHERE NOT list_has_any(staxids, (SELECT list(CAST(s_suppkey AS VARCHAR)) FROM supplier WHERE s_suppkey % 9 = 0))", "hits"))
def env_hit_filter(s, d):
    return hits.drop_taxids(A.hits(s, d), env_taxids(s, d)).select("qseqid", "hit_ord", "sseqid")


@query("multi_taxid_skip", sql("SELECT qseqid, hit_ord, staxids[1] AS taxid FROM hits WHERE len(staxids) = 1", "hits"))
def multi_taxid_skip(s, d):
    return hits.single_taxid(A.hits(s, d)).select("qseqid", "hit_ord", "taxid")


@query("dubious_accession_filter", sql("SELECT qseqid, hit_ord, sseqid FROM hits WHERE split_part(sseqid, '|', 2) NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size = 7)", "hits"))
def dubious_accession_filter(s, d):
    listed = A.read(s, d, "part").where("p_size = 7").select(F.col("p_partkey").cast("string").alias("accession"))
    return hits.drop_accessions(A.hits(s, d), listed).select("qseqid", "hit_ord", "sseqid")


@query("invalid_taxid_skip", sql("SELECT qseqid, hit_ord, TRY_CAST(staxids[1] AS BIGINT) AS taxid FROM hits WHERE TRY_CAST(staxids[1] AS BIGINT) IS NOT NULL", "hits"))
def invalid_taxid_skip(s, d):
    return A.hits(s, d).withColumn("taxid", hits.valid_taxid(F.col("staxids"))).where("taxid is not null").select("qseqid", "hit_ord", "taxid")


@query("sorted_hits", sql("SELECT qseqid, hit_ord, bitscore, CAST(row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, hit_ord) AS INT) AS place FROM hits", "hits"))
def sorted_hits(s, d):
    return hits.sort_hits(A.hits(s, d)).select("qseqid", "hit_ord", "bitscore", "place")


@query("top_hit_per_query", sql("SELECT qseqid, hit_ord, bitscore FROM (SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS b FROM hits) WHERE bitscore = b", "hits"))
def top_hit_per_query(s, d):
    return hits.best_hits(A.hits(s, d)).select("qseqid", "hit_ord", "bitscore")


FIRST = """one AS (SELECT *, staxids[1] AS taxid FROM hits WHERE len(staxids) = 1),
b AS (SELECT * FROM (SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS best FROM one) WHERE bitscore = best),
f AS (SELECT qseqid, taxid, bitscore, pident, qcovs, hit_ord, count(*) OVER (PARTITION BY qseqid, taxid) AS n_hits, row_number() OVER (PARTITION BY qseqid, taxid ORDER BY hit_ord) AS i FROM b),
t AS (SELECT q.qseqid, taxid, bitscore, pident, qcovs, hit_ord, CASE WHEN taxid IS NOT NULL THEN 1 END AS count, n_hits FROM queries_of_hits q LEFT JOIN (SELECT * FROM f WHERE i = 1) f USING (qseqid))"""


def top(s, d):
    return hits.top_hits(A.hits(s, d), A.queries_of_hits(s, d))


@query("first_hit_per_taxid", sql(FIRST + " SELECT qseqid, taxid, bitscore, pident, round(qcovs, 6) AS qcovs, hit_ord, count, n_hits FROM t", "hits", "queries_of_hits"))
def first_hit_per_taxid(s, d):
    return top(s, d).withColumn("qcovs", F.round("qcovs", 6))


@query("top_hit_summary", sql(FIRST + " SELECT qseqid, coalesce(list(taxid ORDER BY hit_ord) FILTER (taxid IS NOT NULL), []) AS taxids FROM t GROUP BY qseqid", "hits", "queries_of_hits"))
def top_hit_summary(s, d):
    return hits.top_hit_summary(top(s, d)).select("qseqid", F.col("hits.taxid").alias("taxids"))


@query("best_taxid_order", sql("SELECT qseqid, taxid, bitscore, n, CAST(row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, n DESC, taxid DESC) AS INT) AS place FROM (SELECT qseqid, staxids[1] AS taxid, max(bitscore) AS bitscore, count(*) AS n FROM hits WHERE len(staxids) = 1 GROUP BY 1, 2)", "hits"))
def best_taxid_order(s, d):
    return taxonomy.best_taxids(hits.single_taxid(A.hits(s, d)))


NOT_ENOUGH = """fs AS (SELECT qseqid, sseqid, arg_min(pident, hit_ord) AS pident, arg_min(mismatch, hit_ord) AS mismatch FROM hits GROUP BY 1, 2),
ne AS (SELECT qseqid, count(DISTINCT pident) AS identities, count(DISTINCT mismatch) AS mismatches FROM fs GROUP BY 1 HAVING count(DISTINCT pident) = 1 OR count(DISTINCT mismatch) = 1)"""


@query("not_enough_hits", sql(NOT_ENOUGH + " SELECT * FROM ne", "hits"))
def not_enough_hits(s, d):
    return hits.not_enough_hits(A.hits(s, d))


@query("needs_deeper_search", sql(NOT_ENOUGH + " SELECT qseqid, size FROM queries_of_hits WHERE size >= 0.01 * (SELECT max(size) FROM queries_of_hits) AND qseqid IN (SELECT qseqid FROM ne)", "hits", "queries_of_hits"))
def needs_deeper_search(s, d):
    return hits.needs_deeper(A.hits(s, d), A.queries_of_hits(s, d)).select("qseqid", "size")


@query("genus_majority_filter", sql("""
r AS (SELECT *, split_part(stitle, ' ', 1) AS genus, row_number() OVER (PARTITION BY qseqid ORDER BY hit_ord) AS i FROM hits),
p AS (SELECT qseqid, count(*) AS n_hits, bool_or(i <= 50 AND (contains(stitle, 'red widget') OR contains(stitle, 'hot gear'))) AS named FROM r GROUP BY 1),
c AS (SELECT qseqid, max(n) AS most FROM (SELECT qseqid, genus, count(*) AS n FROM r WHERE i <= 10 GROUP BY 1, 2) GROUP BY 1)
SELECT qseqid, n_hits, named, most, named OR n_hits < 10 OR most < 6 AS passes FROM p JOIN c USING (qseqid)""", "hits"))  # fmt: skip
def genus_majority_filter(s, d):
    return hits.genus_filter(A.hits(s, d), ["red widget", "hot gear"])


@query("lca_strict_prefix", sql(FIRST + """,
l AS (SELECT t.qseqid, lineage, bitscore FROM t JOIN taxid_lineages USING (taxid)),
g AS (SELECT qseqid, count(DISTINCT lineage[1]) AS c1, count(DISTINCT lineage[2]) AS c2, count(DISTINCT lineage[3]) AS c3, any_value(lineage) AS a, string_agg(DISTINCT lineage[1], '_OR_' ORDER BY lineage[1]) AS tops FROM l GROUP BY 1)
SELECT q.qseqid, CASE WHEN a IS NULL THEN 'k__Unassigned' WHEN c1 > 1 THEN tops WHEN c2 > 1 THEN a[1] WHEN c3 > 1 THEN a[1] || ';' || a[2] ELSE array_to_string(a, ';') END AS taxonomy FROM queries_of_hits q LEFT JOIN g USING (qseqid)""", "hits", "queries_of_hits", "taxid_lineages"))  # fmt: skip
def lca_strict_prefix(s, d):
    return taxonomy.assign_lca(top(s, d), A.taxid_lineages(s, d), "strict_prefix").select("qseqid", "taxonomy")


@query("lca_reference_fold", sql(FIRST + """,
l AS (SELECT t.qseqid, list(lineage ORDER BY hit_ord) AS ls, string_agg(DISTINCT lineage[1], '_OR_' ORDER BY lineage[1]) AS tops FROM t JOIN taxid_lineages USING (taxid) GROUP BY 1),
fl AS (SELECT qseqid, tops, list_reduce(ls, lambda a, b: [a[i] FOR i IN range(1, least(len(a), len(b)) + 1) IF a[i] = b[i] AND NOT contains(a[i], '__unclassified')]) AS lca FROM l)
SELECT q.qseqid, CASE WHEN lca IS NULL THEN 'k__Unassigned' WHEN len(lca) > 0 THEN array_to_string(lca, ';') ELSE tops END AS taxonomy FROM queries_of_hits q LEFT JOIN fl USING (qseqid)""", "hits", "queries_of_hits", "taxid_lineages"))  # fmt: skip
def lca_reference_fold(s, d):
    return taxonomy.assign_lca(top(s, d), A.taxid_lineages(s, d)).select("qseqid", "taxonomy")


LEVELS = {"kingdom": "contains(taxonomy, 'k__') OR contains(taxonomy, 'd__')", **{n: f"contains(taxonomy, '{n[0]}__')" for n in ("phylum", "class", "order", "family", "genus", "species")}, "subspecies": "contains(taxonomy, 'u__')", "unassigned": "contains(taxonomy, 'Unassigned')"}


@query("taxa_level_counts", sql(" UNION ALL ".join(f"SELECT '{n}' AS level, count(*) FILTER ({c}) AS n FROM tu_taxonomy" for n, c in LEVELS.items()), "tu_taxonomy"))
def taxa_level_counts(s, d):
    return taxonomy.level_counts(A.tu_taxonomy(s, d))


@query("mixed_family_top10", sql("""
f AS (SELECT qseqid, unnest(staxids) AS taxid FROM (SELECT *, row_number() OVER (PARTITION BY qseqid ORDER BY hit_ord) AS i FROM hits) WHERE i <= 10)
SELECT qseqid, count(DISTINCT lineage[2]) AS families, count(DISTINCT lineage[2]) > 1 AS mixed FROM f LEFT JOIN taxid_lineages USING (taxid) GROUP BY 1""", "hits", "taxid_lineages"))  # fmt: skip
def mixed_family_top10(s, d):
    return taxonomy.mixed_families(A.hits(s, d), A.taxid_lineages(s, d).select("taxid", F.col("lineage")[1].alias("family")))


@query("keyword_classify", sql("SELECT tu_id, CASE WHEN split_part(taxonomy, ';', -1) IN ('p__hot gear', 'p__red bolt') OR contains(split_part(taxonomy, ';', -1), 'widget') THEN 'solid' WHEN contains(taxonomy, 'blue') THEN 'putative' END AS class FROM tu_taxonomy", "tu_taxonomy"))
def keyword_classify(s, d):
    return taxonomy.classify_by_keyword(A.tu_taxonomy(s, d), ["p__hot gear", "p__red bolt"], ["widget"], ["blue"]).select("tu_id", "class")


@query("lineage_build", """
SELECT CAST(s_suppkey + 1000 AS VARCHAR) AS taxid, array_to_string(['d__' || replace(r_name, ' ', '_'), 'k__Unassigned', 'p__' || n_name, 'c__unclassified_' || n_name, 'o__unclassified_' || n_name, 'f__unclassified_' || n_name, 'g__unclassified_' || n_name, 's__' || replace(s_name, ' ', '_')], ';') AS lineage
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")  # fmt: skip
def lineage_build(s, d):
    region, nation, supplier = (A.read(s, d, t) for t in ("region", "nation", "supplier"))
    nodes = region.select(F.concat(F.lit("r"), "r_regionkey").alias("taxid"), F.lit(None).cast("string").alias("parent"), F.lit("domain").alias("rank"), F.col("r_name").alias("name"))
    nodes = nodes.unionByName(nation.select(F.concat(F.lit("n"), "n_nationkey").alias("taxid"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.lit("phylum").alias("rank"), F.col("n_name").alias("name")))
    nodes = nodes.unionByName(supplier.select((F.col("s_suppkey") + 1000).cast("string").alias("taxid"), F.concat(F.lit("n"), "s_nationkey").alias("parent"), F.lit("species").alias("rank"), F.col("s_name").alias("name")))
    return taxonomy.lineages(nodes).where("taxid rlike '^[0-9]'").select("taxid", F.array_join("lineage", ";").alias("lineage"))


CLASSED = """cls AS (SELECT s_suppkey AS taxid, CASE WHEN s_suppkey % 5 = 2 THEN 'R' WHEN s_suppkey % 6 = 1 THEN 'E' WHEN s_suppkey % 4 = 0 THEN 'K' ELSE 'U' END AS class FROM supplier),
ch AS (SELECT h.*, CAST(staxids[1] AS BIGINT) AS taxid, coalesce(class, 'U') AS class FROM hits h LEFT JOIN cls ON cls.taxid = CAST(staxids[1] AS BIGINT)),
ini AS (SELECT q.qseqid, size, coalesce(code, 'N') AS initial FROM queries_of_hits q LEFT JOIN (SELECT qseqid, string_agg(DISTINCT class, '' ORDER BY class) AS code FROM ch GROUP BY 1) USING (qseqid))"""
SCORED = CLASSED + """,
tb AS (SELECT qseqid, taxid, class, bitscore, count(*) AS n FROM (SELECT *, max(bitscore) OVER (PARTITION BY qseqid, taxid) AS b FROM ch) WHERE bitscore = b GROUP BY ALL),
sc AS (SELECT qseqid, """ + ", ".join(f"max(bitscore) FILTER (class = '{c}') AS b{c}, coalesce(sum(n) FILTER (class = '{c}'), 0) AS c{c}, count(*) FILTER (class = '{c}') AS n{c}" for c in "EKRU") + """
 FROM (SELECT *, max(bitscore) OVER (PARTITION BY qseqid, class) AS cb FROM tb) WHERE bitscore = cb GROUP BY 1),
kr AS (SELECT ini.*, CASE WHEN initial IN ('E','EK','EKU','K','N') THEN 'K' WHEN initial IN ('ER','ERU','R','RU','U') THEN 'R'
 WHEN initial = 'EKRU' THEN CASE WHEN bK < bR OR (bK = bR AND cK <= cR AND nK <= nR) OR (bK = bU AND cK <= cU) THEN 'R' ELSE 'K' END
 WHEN initial IN ('EKR','KR') THEN CASE WHEN bK < bR OR (bK = bR AND cK <= cR) THEN 'R' ELSE 'K' END
 WHEN initial = 'EU' THEN CASE WHEN bE < bU AND (cE <= cU OR nE < nU) THEN 'R' ELSE 'K' END
 WHEN initial = 'KU' THEN CASE WHEN (bK < bU AND nK < nU) OR (bK = bU AND nK <= nU) THEN 'R' ELSE 'K' END
 WHEN initial = 'KRU' THEN CASE WHEN bK <= bR THEN 'R' ELSE 'K' END END AS final FROM ini LEFT JOIN sc USING (qseqid))"""  # fmt: skip


def classes(s, d):
    return categorize.taxid_classes(*A.taxid_lists(s, d))


@query("ekru_designation", sql(CLASSED + " SELECT qseqid, initial FROM ini", "hits", "queries_of_hits"))
def ekru_designation(s, d):
    return categorize.designate(A.hits(s, d), A.queries_of_hits(s, d), classes(s, d)).select("qseqid", "initial")


@query("keep_reject", sql(SCORED + " SELECT qseqid, size, initial, final FROM kr", "hits", "queries_of_hits"))
def keep_reject(s, d):
    return categorize.keep_reject(A.hits(s, d), A.queries_of_hits(s, d), classes(s, d)).select("qseqid", "size", "initial", "final")


TITLED = "CASE WHEN CAST(split_part(sseqid, '|', 2) AS BIGINT) % 3 = 0 THEN 'Chloroplast' ELSE stitle END"
PHIX = SCORED.replace("count(*) AS n FROM (SELECT *, max", f"count(*) AS n, arg_min({TITLED}, hit_ord) AS title, min(hit_ord) AS ho FROM (SELECT *, max").replace(
    " FROM (SELECT *, max(bitscore) OVER (PARTITION BY qseqid, class)", ", arg_min(title, ho) FILTER (class = 'U') AS u_title, coalesce(bool_or(class = 'R' AND taxid % 10 = 2), false) AS phix FROM (SELECT *, max(bitscore) OVER (PARTITION BY qseqid, class)").replace(
    "nE < nU) THEN 'R'", "nE < nU) OR (bE = bU AND contains(lower(u_title), 'chloroplast')) THEN 'R'").replace(
    "CASE WHEN bK <= bR THEN 'R'", "CASE WHEN bK <= bR OR (phix AND (bK <= bU OR cR > 2)) THEN 'R'").replace("GROUP BY ALL", "GROUP BY qseqid, taxid, class, bitscore")


@query("keep_reject_phix", sql(PHIX + " SELECT qseqid, size, initial, final FROM kr", "hits", "queries_of_hits"))
def keep_reject_phix(s, d):
    title = F.when(F.split("sseqid", r"\|")[1].cast("bigint") % 3 == 0, "Chloroplast").otherwise(F.col("stitle"))
    phage = [r[0] for r in A.read(s, d, "supplier").where("s_suppkey % 10 = 2").select("s_suppkey").collect()]
    return categorize.keep_reject(A.hits(s, d).withColumn("stitle", title), A.queries_of_hits(s, d), classes(s, d), phage).select("qseqid", "size", "initial", "final")


@query("designation_summary", sql(SCORED + " SELECT initial, final, count(*) AS units, CAST(sum(size) AS BIGINT) AS reads, round(sum(size) / count(*), 6) AS reads_per_unit FROM kr GROUP BY GROUPING SETS ((initial, final), (final), ())", "hits", "queries_of_hits"))
def designation_summary(s, d):
    out = categorize.summarize(categorize.keep_reject(A.hits(s, d), A.queries_of_hits(s, d), classes(s, d)))
    return out.withColumn("reads_per_unit", F.round("reads_per_unit", 6))


@query("suspicious_accessions", sql(CLASSED + """,
bb AS (SELECT * FROM (SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS b FROM ch) WHERE bitscore = b),
o AS (SELECT qseqid, count(*) FILTER (class = 'K') AS k, count(*) FILTER (class = 'R') AS r FROM bb GROUP BY 1)
SELECT sseqid AS accession, class, count(*) AS n FROM bb JOIN o USING (qseqid) WHERE ((k = 1 AND r > 1) OR (r = 1 AND k > 1)) AND class = CASE WHEN k = 1 THEN 'K' ELSE 'R' END GROUP BY 1, 2""", "hits", "queries_of_hits"))  # fmt: skip
def suspicious_accessions(s, d):
    return categorize.suspicious_accessions(categorize.hit_classes(A.hits(s, d), classes(s, d)), many=1)


@query("merged_taxids", "SELECT s_suppkey AS taxid FROM supplier WHERE s_suppkey % 4 = 0 UNION SELECT s_suppkey + 100000 FROM supplier WHERE s_suppkey % 4 = 0")
def merged_taxids(s, d):
    merged = A.read(s, d, "supplier").select((F.col("s_suppkey") + 100000).alias("old"), F.col("s_suppkey").alias("new"))
    return categorize.with_merged(A.taxid_lists(s, d)[0], merged)


@query("hits_by_header", sql("SELECT qseqid, sseqid, bitscore, staxids, row_number() OVER (PARTITION BY qseqid ORDER BY hit_ord) AS place FROM hits", "hits"))
def hits_by_header(s, d):
    """Hits written as lines in an order of columns that only their header tells, and read back."""
    h = A.hits(s, d)
    cells = F.concat_ws("\t", F.array_join("staxids", ";"), F.col("bitscore").cast("string"), "stitle", "qseqid", "sseqid")
    order = F.col("qseqid").cast("bigint") * 1000 + F.col("hit_ord")
    lines = h.select(cells.alias("value"), order.alias("ord"))
    head = s.createDataFrame([("# Fields: subject tax ids, bit score, subject title, query id, subject id", -1)], "value string, ord bigint")
    got = text.parse_hits(head.unionByName(lines))[0]
    place = F.row_number().over(Window.partitionBy("qseqid").orderBy("hit_ord")).cast("bigint")
    return got.select("qseqid", "sseqid", "bitscore", "staxids", place.alias("place"))
