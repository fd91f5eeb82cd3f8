"""Queries over feature tables and statistics, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaflow.functions.ordering import adjust_bh
from taxaflow.operators import report, stats, table
from taxaflow.plans import adapters as A
from taxaflow.plans.adapters import sql

Q, O = {}, {}  # noqa: E741


def query(name: str, oracle: str | None = None):
    def keep(f):
        Q[name] = f
        if oracle:
            O[name] = oracle
        return f

    return keep


def rounded(df, *columns, digits=9):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df




REL = "rel AS (SELECT f.*, n / sum(n) OVER (PARTITION BY sample_id) AS rel FROM feature_long f)"


@query("relative_frequency", sql(REL + " SELECT * FROM rel", "feature_long"))
def relative_frequency(s, d):
    return table.normalize(A.feature_long(s, d))


#: The event types of the test tables.
EVENTS = ["click", "error", "purchase", "signup", "view"]


@query("feature_pivot", sql("SELECT tu_id, " + ", ".join(f"CAST(coalesce(max(n) FILTER (sample_id = '{e}'), 0) AS BIGINT) AS \"{e}\"" for e in EVENTS) + " FROM feature_small GROUP BY tu_id", "feature_small"))
def feature_pivot(s, d):
    return table.wide(A.feature_small(s, d), EVENTS)


@query("feature_unpivot", sql("SELECT tu_id, sample_id, n FROM feature_small WHERE sample_id IN (" + ", ".join(f"'{e}'" for e in EVENTS) + ")", "feature_small"))
def feature_unpivot(s, d):
    return table.long(table.wide(A.feature_small(s, d), EVENTS), EVENTS)


for level in (1, 2, 3):
    O[f"collapse_level_{level}"] = sql(f"SELECT array_to_string(lineage[1:{level}], ';') AS taxon, sample_id, CAST(sum(n) AS BIGINT) AS n FROM feature_long JOIN tu_taxonomy USING (tu_id) GROUP BY 1, 2", "feature_long", "tu_taxonomy")
    Q[f"collapse_level_{level}"] = lambda s, d, level=level: table.collapse(A.feature_long(s, d), A.tu_taxonomy(s, d), level)


@query("collapse_relative", sql(REL + " SELECT array_to_string(lineage[1:2], ';') AS taxon, sample_id, round(sum(rel), 12) AS rel FROM rel JOIN tu_taxonomy USING (tu_id) GROUP BY 1, 2", "feature_long", "tu_taxonomy"))
def collapse_relative(s, d):
    return rounded(table.collapse(table.normalize(A.feature_long(s, d)).drop("n"), A.tu_taxonomy(s, d), 2, "rel"), "rel", digits=12)


@query("avg_abundance_dense", sql(REL + " SELECT tu_id, round(sum(rel) / (SELECT count(DISTINCT sample_id) FROM rel), 12) AS avg_abun FROM rel GROUP BY tu_id", "feature_long"))
def avg_abundance_dense(s, d):
    return rounded(table.average_abundance(table.normalize(A.feature_long(s, d))), "avg_abun", digits=12)


COMPOSED = REL + """,
taxa AS (SELECT array_to_string(lineage[1:2], ';') AS taxon, sample_id, sum(rel) AS v FROM rel JOIN tu_taxonomy USING (tu_id) GROUP BY 1, 2),
sizes AS (SELECT grp AS treatment, count(*) AS c FROM (SELECT DISTINCT sample_id FROM rel) JOIN sample_map USING (sample_id) GROUP BY grp),
means AS (SELECT grp AS treatment, taxon, sum(v) / any_value(c) AS mean FROM taxa JOIN sample_map USING (sample_id) JOIN sizes ON sizes.treatment = grp GROUP BY 1, 2),
tops AS (SELECT treatment, taxon FROM (SELECT *, row_number() OVER (PARTITION BY treatment ORDER BY round(mean, 12) DESC, taxon) AS i FROM means) WHERE i <= 5),"""


@query("topn_other_composition", sql(COMPOSED + """
r AS (SELECT m.treatment, CASE WHEN t.taxon IS NULL THEN 'other' ELSE m.taxon END AS taxon, sum(mean) AS mean FROM means m LEFT JOIN tops t ON t.treatment = m.treatment AND t.taxon = m.taxon GROUP BY 1, 2)
SELECT treatment, taxon, round(mean * 100 / sum(mean) OVER (PARTITION BY treatment), 6) AS percent FROM r""", "feature_long", "tu_taxonomy", "sample_map"))  # fmt: skip
def topn_other_composition(s, d):
    taxa = table.with_taxon(table.normalize(A.feature_long(s, d)), A.tu_taxonomy(s, d), 2, "rel")
    return rounded(report.composition(taxa, A.sample_map(s, d), "grp", n=5, mode="per_treatment", samples=A.feature_samples(s, d)), "percent", digits=6)


@query("average_composition", sql(COMPOSED + """
a AS (SELECT taxon, sum(mean) / (SELECT count(*) FROM sizes) AS mean FROM means GROUP BY taxon),
r AS (SELECT CASE WHEN taxon IN (SELECT taxon FROM tops) THEN taxon ELSE 'other' END AS taxon, sum(mean) AS mean FROM a GROUP BY 1)
SELECT 'average' AS treatment, taxon, round(mean * 100 / sum(mean) OVER (), 6) AS percent FROM r""", "feature_long", "tu_taxonomy", "sample_map"))  # fmt: skip
def average_composition(s, d):
    taxa = table.with_taxon(table.normalize(A.feature_long(s, d)), A.tu_taxonomy(s, d), 2, "rel")
    return rounded(report.composition(taxa, A.sample_map(s, d), "grp", keep="value", n=5, samples=A.feature_samples(s, d)), "percent", digits=6)


@query("table_merge_zero_fill", sql("SELECT tu_id, sample_id, n FROM feature_long UNION ALL SELECT tu_id, sample_id, n FROM feature_small", "feature_long", "feature_small"))
def table_merge_zero_fill(s, d):
    return table.merge(A.feature_long(s, d), A.feature_small(s, d))


@query("row_totals_sorted_labels", sql("SELECT *, 'T' || rank AS label FROM (SELECT tu_id, CAST(sum(n) AS BIGINT) AS total, row_number() OVER (ORDER BY sum(n) DESC, tu_id) AS rank FROM feature_long GROUP BY tu_id)", "feature_long"))
def row_totals_sorted_labels(s, d):
    return table.rank_units(A.feature_long(s, d), "T").select("tu_id", "total", "rank", "label")


@query("column_totals_nd_row", sql("SELECT 'nd' AS tu_id, sample_id, CAST(sum(n) AS BIGINT) AS n FROM feature_long GROUP BY sample_id UNION ALL SELECT tu_id, sample_id, n FROM feature_long", "feature_long"))
def column_totals_nd_row(s, d):
    return table.with_total_row(A.feature_long(s, d))


@query("summarize_samples", sql("SELECT sample_id, count(*) FILTER (n > 0) AS units, CAST(sum(n) AS BIGINT) AS total FROM feature_long GROUP BY sample_id", "feature_long"))
def summarize_samples(s, d):
    return table.summarize_samples(A.feature_long(s, d))


@query("keep_list", sql("SELECT f.* FROM feature_long f WHERE tu_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 25)", "feature_long"))
def keep_list(s, d):
    return table.keep_units(A.feature_long(s, d), A.read(s, d, "part").where("p_size > 25").select(F.col("p_partkey").cast("string").alias("tu_id")))


@query("exclude_taxa", sql("SELECT f.* FROM feature_long f WHERE tu_id NOT IN (SELECT tu_id FROM tu_taxonomy WHERE regexp_matches(taxonomy, '(?i)(?:p__red)|(?:brand#1[0-3])'))", "feature_long", "tu_taxonomy"))
def exclude_taxa(s, d):
    return table.exclude_taxa(A.feature_long(s, d), A.tu_taxonomy(s, d), ["P__RED", "brand#1[0-3]"])


@query("domain_split", sql("SELECT f.*, CASE WHEN starts_with(taxonomy, 'd__SMALL') THEN 'SMALL' WHEN starts_with(taxonomy, 'd__ECONOMY') THEN 'ECONOMY' END AS domain FROM feature_long f JOIN tu_taxonomy USING (tu_id) WHERE starts_with(taxonomy, 'd__SMALL') OR starts_with(taxonomy, 'd__ECONOMY')", "feature_long", "tu_taxonomy"))
def domain_split(s, d):
    parts = table.split_domains(A.feature_long(s, d), A.tu_taxonomy(s, d), ("SMALL", "ECONOMY"))
    one, two = (t.withColumn("domain", F.lit(k)) for k, t in parts.items())
    return one.unionByName(two)


@query("multiply_rint", sql("SELECT tu_id, sample_id, round_even(CAST(n AS DOUBLE) * CAST(0.3 AS DOUBLE), 0) AS n FROM feature_long", "feature_long"))
def multiply_rint(s, d):
    return table.multiply(A.feature_long(s, d), 0.3)


@query("divide_constant", sql("SELECT tu_id, sample_id, round(n / 7, 9) AS n FROM feature_long", "feature_long"))
def divide_constant(s, d):
    return rounded(table.divide(A.feature_long(s, d), 7.0), "n")


@query("divide_by_list", sql("SELECT tu_id, sample_id, round(coalesce(n / divisor, 0), 9) AS n FROM feature_long LEFT JOIN (SELECT CAST(p_partkey AS VARCHAR) AS tu_id, CAST(p_size AS DOUBLE) AS divisor FROM part WHERE p_size % 2 = 0) USING (tu_id)", "feature_long"))
def divide_by_list(s, d):
    divisors = A.read(s, d, "part").where("p_size % 2 = 0").select(F.col("p_partkey").cast("string").alias("tu_id"), F.col("p_size").cast("double").alias("divisor"))
    return rounded(table.divide_by_list(A.feature_long(s, d), divisors), "n")


@query("max_possible_depth", sql("SELECT min(t) AS max_depth FROM (SELECT CAST(sum(CAST(trunc(n * CAST(0.7 AS DOUBLE)) AS BIGINT)) AS BIGINT) AS t FROM feature_long GROUP BY sample_id)", "feature_long"))
def max_possible_depth(s, d):
    return table.max_depth(A.feature_long(s, d).withColumn("n", F.col("n") * F.lit(0.7)))


GRID = """grid AS (SELECT u.tu_id, s.sample_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT tu_id FROM feature_long) u CROSS JOIN (SELECT DISTINCT sample_id FROM feature_long) s LEFT JOIN feature_long f ON f.tu_id = u.tu_id AND f.sample_id = s.sample_id)"""


@query("pseudocount_normalize", sql(GRID + " SELECT tu_id, sample_id, n, round((n + 1) / sum(n + 1) OVER (PARTITION BY sample_id), 12) AS rel FROM grid", "feature_long"))
def pseudocount_normalize(s, d):
    return table.with_pseudocount(A.feature_long(s, d), digits=12)


MEANS = GRID + """,
p AS (SELECT tu_id, sample_id, (n + 1) / sum(n + 1) OVER (PARTITION BY sample_id) AS rel FROM grid),
m AS (SELECT tu_id, grp, CASE WHEN value > 5000 THEN 'after' ELSE 'before' END AS phase, avg(rel) AS mean FROM p JOIN sample_map USING (sample_id) GROUP BY 1, 2, 3)"""


def phase_means(s, d):
    meta = A.sample_map(s, d).withColumn("phase", F.when(F.col("value") > 5000, "after").otherwise("before"))
    return stats.group_means(A.feature_long(s, d), meta, "phase", "grp")


@query("fold_change", sql(MEANS + " SELECT a.tu_id, a.grp, round(b.mean, 12) AS before, round(a.mean, 12) AS after, round(a.mean / b.mean, 6) AS change FROM m a JOIN m b ON a.tu_id = b.tu_id AND a.grp = b.grp AND a.phase = 'after' AND b.phase = 'before'", "feature_long", "sample_map"))
def fold_change(s, d):
    return rounded(rounded(stats.fold_changes(phase_means(s, d), "phase", "grp", "before", "after"), "before", "after", digits=12), "change", digits=6)


@query("spearman_vs_fold_change")
def spearman_vs_fold_change(s, d):
    return stats.correlate_with_change(phase_means(s, d), "phase", "grp", "before", "before", "after")


@query("spearman_vs_external")
def spearman_vs_external(s, d):
    prior = stats.correlate_with_change(phase_means(s, d), "phase", "grp", "before", "before", "after").select("tu_id", "groups", "changes")
    external = A.sample_map(s, d).groupBy(F.col("grp").alias("name")).agg(F.avg("value").alias("value"))
    return stats.correlate_with_external(prior, external)


RANK = "rank() OVER (PARTITION BY {k} ORDER BY {v}) + (count(*) OVER (PARTITION BY {k}, {v}) - 1) / 2"


@query("spearman_vs_column", sql(GRID + f""",
v AS (SELECT tu_id FROM grid GROUP BY tu_id HAVING min(n) <> max(n)),
r AS (SELECT tu_id, n, {RANK.format(k='tu_id', v='n')} AS x, {RANK.format(k='tu_id', v='value')} AS y FROM grid JOIN v USING (tu_id) JOIN sample_map USING (sample_id))
SELECT tu_id, count(*) AS n, round(corr(x, y), 9) AS rho, round(avg(n), 9) AS average FROM r GROUP BY tu_id""", "feature_long", "sample_map"))  # fmt: skip
def spearman_vs_column(s, d):
    out = stats.correlate_with_column(A.feature_long(s, d), A.sample_map(s, d), "value")
    return rounded(out.select("tu_id", "n", "rho", "average"), "rho", "average")


@query("spearman_vs_column_significance")
def spearman_vs_column_significance(s, d):
    return stats.correlate_with_column(A.feature_long(s, d), A.sample_map(s, d), "value")


SMALL = "grid AS (SELECT u.tu_id, s.sample_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT tu_id FROM feature_small) u CROSS JOIN (SELECT DISTINCT sample_id FROM feature_small) s LEFT JOIN feature_small f ON f.tu_id = u.tu_id AND f.sample_id = s.sample_id)"


@query("spearman_pairs_thresholded", sql(SMALL + f""",
r AS (SELECT tu_id, sample_id, {RANK.format(k='tu_id', v='n')} AS x FROM grid),
c AS (SELECT a.tu_id AS a, b.tu_id AS b, count(*) AS n, CASE WHEN stddev_pop(a.x) = 0 OR stddev_pop(b.x) = 0 THEN 0.0 ELSE covar_pop(a.x, b.x) / (stddev_pop(a.x) * stddev_pop(b.x)) END AS rho FROM r a JOIN r b USING (sample_id) WHERE a.tu_id < b.tu_id GROUP BY 1, 2)
SELECT a, b, n, round(rho, 9) AS rho FROM c WHERE rho >= 0.85 OR rho <= -0.85""", "feature_small"))  # fmt: skip
def spearman_pairs_thresholded(s, d):
    grid = table.dense(A.feature_small(s, d))
    return stats.correlate_units(grid, "tu_id", "sample_id", "n", high=0.85, low=-0.85, digits=9).select("a", "b", "n", "rho")


@query("bh_fdr", """
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS tu_id, (p_partkey * 7919 % 997 + 1) / 1000 AS p FROM part),
r AS (SELECT *, row_number() OVER (ORDER BY p, tu_id) AS k, count(*) OVER () AS m FROM p)
SELECT tu_id, round(p, 6) AS p, round(least(1, min(p * m / k) OVER (ORDER BY k DESC)), 9) AS p_adj FROM r""")  # fmt: skip
def bh_fdr(s, d):
    p = A.read(s, d, "part").select(F.col("p_partkey").cast("string").alias("tu_id"), ((F.col("p_partkey") * 7919 % 997 + 1) / 1000).alias("p"))
    return rounded(rounded(adjust_bh(p), "p", digits=6), "p_adj")


FACTS = REL + """,
facts AS (SELECT tu_id, round(sum(rel) / (SELECT count(DISTINCT sample_id) FROM rel), 12) AS avg_abun, any_value('>' || tu_id || '#' || p_name) AS Sequence, any_value(taxonomy) AS taxonomy
          FROM rel JOIN tu_taxonomy USING (tu_id) JOIN part ON CAST(p_partkey AS VARCHAR) = tu_id GROUP BY tu_id)"""


def unit_facts(s, d):
    seqs = A.read(s, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("seq"))
    tax = A.tu_taxonomy(s, d).select(F.col("tu_id").alias("qseqid"), "taxonomy", F.lit(100.0).alias("per_id"), F.lit(99.0).alias("per_qcov"))
    return report.taxonomy_summary(table.normalize(A.feature_long(s, d)), seqs, tax)


@query("mini_summary", sql(FACTS + " SELECT tu_id, Sequence, taxonomy, 100.0::DOUBLE AS per_ID, 99.0::DOUBLE AS per_qcov, avg_abun FROM facts", "feature_long", "tu_taxonomy"))
def mini_summary(s, d):
    return rounded(unit_facts(s, d), "avg_abun", digits=12)


@query("detailed_table", sql(FACTS + """, mixed AS (SELECT CAST(p_partkey AS VARCHAR) AS tu_id FROM part WHERE p_size < 5),
cells AS (SELECT 'nd' AS tu_id, sample_id, CAST(sum(n) AS DOUBLE) AS value FROM feature_long GROUP BY sample_id UNION ALL SELECT tu_id, sample_id, rel FROM rel)
SELECT tu_id, sample_id, value, Sequence, taxonomy, avg_abun, CASE WHEN tu_id IN (SELECT tu_id FROM mixed) THEN 'yes' WHEN Sequence IS NOT NULL THEN 'no' END AS mixed FROM cells LEFT JOIN facts USING (tu_id)""", "feature_long", "tu_taxonomy"))  # fmt: skip
def detailed_table(s, d):
    mixed = A.read(s, d, "part").where("p_size < 5").select(F.concat(F.col("p_partkey").cast("string"), F.lit("_12")).alias("qseqid"))
    facts = report.flag_mixed(unit_facts(s, d), mixed).select("tu_id", "Sequence", "taxonomy", "avg_abun", "mixed")
    ft = A.feature_long(s, d)
    return rounded(report.detailed_long(table.normalize(ft), ft, facts), "avg_abun", digits=12)
