"""Search hits: filters, best hits of each query, and checks of their depth.

Hits are (qseqid, sseqid, pident, length, mismatch, evalue, bitscore, staxids array, stitle, qcovs, hit_ord); queries
are a table of their own (qseqid, size, q_ord), so that queries without hits stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.staging import materialize


def drop_taxids(hits: DataFrame, taxids: DataFrame) -> DataFrame:
    """Drops hits of which any taxid is listed (taxid)."""
    listed = hits.select("qseqid", "hit_ord", F.explode("staxids").alias("taxid")).join(taxids.select("taxid").distinct(), "taxid", "left_semi")
    return hits.join(listed.select("qseqid", "hit_ord").distinct(), ["qseqid", "hit_ord"], "left_anti")


def single_taxid(hits: DataFrame) -> DataFrame:
    """Hits with exactly one taxid, as column taxid."""
    return hits.where(F.size("staxids") == 1).withColumn("taxid", F.col("staxids")[0])


def drop_accessions(hits: DataFrame, accessions: DataFrame) -> DataFrame:
    """Drops hits whose accession (the last but one part of ``sseqid`` between bars) is listed (accession)."""
    parts = F.split("sseqid", r"\|")
    named = hits.withColumn("accession", F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2))).otherwise(F.col("sseqid")))
    return named.join(accessions.select("accession").distinct(), "accession", "left_anti").drop("accession")


def valid_taxid(taxids: Column) -> Column:
    """The first taxid as an integer, null if it isn't one."""
    return F.get(taxids, F.lit(0)).try_cast("bigint")


def order_in_query(score: str = "bitscore") -> Window:
    return Window.partitionBy("qseqid").orderBy(F.desc(score), "hit_ord")


def sort_hits(hits: DataFrame) -> DataFrame:
    """Adds place: hits of a query by bit score, best first, file order among equals."""
    return hits.withColumn("place", F.row_number().over(order_in_query()))


def best_hits(hits: DataFrame) -> DataFrame:
    """All hits at their query's highest bit score."""
    most = hits.groupBy("qseqid").agg(F.max("bitscore").alias("bitscore"))
    return hits.join(most, ["qseqid", "bitscore"], "left_semi")


def top_hits(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """(qseqid, taxid, bitscore, pident, qcovs, count, n_hits): of the best hits, the first of each taxid.

    ``count`` is 1 as in the summary format, ``n_hits`` the true number; a query without hits has one row of nulls.
    """
    first = F.min_by(F.struct("bitscore", "pident", "qcovs", "hit_ord"), "hit_ord").alias("h")
    each = best_hits(single_taxid(hits)).groupBy("qseqid", "taxid").agg(first, F.count(F.lit(1)).alias("n_hits"))
    each = each.select("qseqid", "taxid", "h.*", F.lit(1).alias("count"), "n_hits")
    return queries.select("qseqid").join(each, "qseqid", "left")


def top_hit_summary(top: DataFrame) -> DataFrame:
    """(qseqid, hits): top hits of a query as an array in hit order, empty without hits."""
    item = F.struct("hit_ord", "bitscore", "pident", "taxid", "count", "qcovs")
    grouped = top.groupBy("qseqid").agg(F.sort_array(F.collect_list(F.when(F.col("taxid").isNotNull(), item))).alias("h"))
    return grouped.select("qseqid", F.transform("h", lambda x: x.dropFields("hit_ord")).alias("hits"))


def render_summary(summary: DataFrame) -> DataFrame:
    """The summary as text: ``[(bitscore|pident|taxid|count|qcov) ...]``."""
    one = lambda x: F.format_string("(%s|%s|%s|%s|%s)", x.bitscore.cast("string"), x.pident.cast("string"), x.taxid.cast("string"), x["count"].cast("string"), x.qcovs.cast("string"))
    return summary.select("qseqid", F.concat(F.lit("["), F.array_join(F.transform("hits", one), " "), F.lit("]")).alias("value"))


def not_enough_hits(hits: DataFrame, mode: str = "documented") -> DataFrame:
    """Queries whose hits (first of each subject) have one distinct identity or one distinct mismatch count.

    ``mode='reference'`` looks only at queries named Otu.
    """
    own = hits.select("qseqid", "sseqid", "pident", "mismatch", "hit_ord").repartition("qseqid")  # both groupings are done where a query's hits are
    first = own.groupBy("qseqid", "sseqid").agg(F.min_by(F.struct("pident", "mismatch"), "hit_ord").alias("h"))
    different = lambda c: F.size(F.collect_set(F.col(c) + 0)).cast("long")  # noqa: E731  a zero with a sign is the other one
    out = first.groupBy("qseqid").agg(different("h.pident").alias("identities"), different("h.mismatch").alias("mismatches"))
    out = out.where((F.col("identities") == 1) | (F.col("mismatches") == 1))
    return out.where(F.col("qseqid").startswith("Otu")) if mode == "reference" else out


def needs_deeper(hits: DataFrame, queries: DataFrame, least_share: float = 0.01, mode: str = "documented") -> DataFrame:
    """Queries to search again with more hits: too alike ones among those of ``least_share`` of the largest's size."""
    largest = queries.agg(F.max("size").alias("_max"))
    large = queries.crossJoin(F.broadcast(largest)).where(F.col("size") >= least_share * F.col("_max")).drop("_max")
    return large.join(not_enough_hits(hits, mode).select("qseqid"), "qseqid", "left_semi")


def deepen(first: DataFrame, queries: DataFrame, search, least_share: float = 0.01, mode: str = "documented", rounds: int = 1) -> tuple[DataFrame, DataFrame]:
    """Hits after searching again, and the queries that would still need it.

    Queries whose hits are too alike (see ``needs_deeper``) go to ``search``, a function from queries and round to their
    hits at a greater depth, for as many rounds as depths are left. Its hits are added to those of the rounds before. What is
    found is written down in each round, so that no search is done twice; the queries left after the last one are only computed
    if they are asked for.
    """
    every, last = first, first
    need = needs_deeper(last, queries, least_share, mode)
    for i in range(rounds):
        last = materialize(search(materialize(need, "deeper"), i + 1), "deeper-hits")
        every = every.unionByName(last)
        need = needs_deeper(last, queries, least_share, mode)
    return every, need


def genus_filter(hits: DataFrame, genera: list[str], titles: int = 50, top: int = 10, majority: int = 6) -> DataFrame:
    """(qseqid, n_hits, named, most, passes): whether a query may belong to the genera.

    It passes if one of the genera is in its first ``titles`` titles, or it has fewer than ``top`` hits, or the
    commonest genus (first word) of its first ``top`` titles has fewer than ``majority`` of them.
    """
    ranked = hits.withColumn("_i", F.row_number().over(Window.partitionBy("qseqid").orderBy("hit_ord")))
    ranked = ranked.withColumn("genus", F.split("stitle", " ")[0])
    named = F.lit(False)
    for g in genera:
        named = named | F.col("stitle").contains(g)
    per = ranked.groupBy("qseqid").agg(F.count(F.lit(1)).alias("n_hits"), F.coalesce(F.bool_or(named & (F.col("_i") <= titles)), F.lit(False)).alias("named"))
    counts = ranked.where(F.col("_i") <= top).groupBy("qseqid", "genus").agg(F.count(F.lit(1)).alias("n")).groupBy("qseqid").agg(F.max("n").alias("most"))
    out = per.join(counts, "qseqid", "left")
    return out.withColumn("passes", F.col("named") | (F.col("n_hits") < top) | (F.col("most") < majority))


def parse_query_line(line: Column) -> Column:
    """(id, size) of a query line in one of four forms: ``id n``, ``id;size=n``, ``id len=n``, ``NODE_x_length_n...``."""
    text = F.trim(F.regexp_replace(line, "^# Query: *", ""))
    size = F.coalesce(*[F.regexp_extract(text, p, 1).try_cast("bigint") for p in (r"size=(\d+)", r" len=(\d+)", r"^NODE_\d+_length_(\d+)", r"^\S+\s+(\d+)\s*$")])
    return F.struct(F.regexp_extract(text, r"^([^\s;]+)", 1).alias("qseqid"), size.alias("size"))
