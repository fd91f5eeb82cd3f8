"""Equal sequences as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.ordering import row_number


def uniques(reads: DataFrame, least: int = 1, *by: str) -> DataFrame:
    """(by..., seq, size): distinct sequences seen at least ``least`` times (in each group)."""
    return reads.groupBy(*by, "seq").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least)


def label(found: DataFrame, prefix: str = "Uniq") -> DataFrame:
    """Adds ord (by size, largest first, then sequence) and id."""
    ranked = row_number(found, [F.desc("size"), F.asc("seq")], "ord")
    return ranked.withColumn("id", F.concat(F.lit(prefix), F.col("ord").cast("string")))


def label_in_groups(found: DataFrame, group: str, prefix: str = "Uniq") -> DataFrame:
    """Adds ord and id within each group. Groups are few and large, so all are numbered at once and start from their
    first number, instead of a task for each."""
    ranked = row_number(found, [F.col(group).asc(), F.desc("size"), F.asc("seq")], "_i")
    firsts = ranked.groupBy(F.col(group).alias("_g")).agg(F.min("_i").alias("_first"))
    ranked = ranked.join(firsts, F.col(group).eqNullSafe(F.col("_g")))
    ranked = ranked.withColumn("ord", (F.col("_i") - F.col("_first") + 1).cast("int")).drop("_i", "_g", "_first")
    return ranked.withColumn("id", F.concat(F.lit(prefix), F.col("ord").cast("string")))


def merge_identical(seqs: DataFrame) -> DataFrame:
    """(id, member_ids, seq, ord): sequences equal but for case as one, ids in first-seen order, joined by commas."""
    g = seqs.groupBy(F.upper("seq").alias("seq")).agg(F.array_sort(F.collect_list(F.struct("ord", "id"))).alias("m"), F.min("ord").alias("ord"))
    ids = F.transform("m", lambda x: x["id"])
    return g.select(F.array_join(ids, ",").alias("id"), ids.alias("member_ids"), "seq", "ord")


def add_counts(seqs: DataFrame, totals: DataFrame, relabel: str | None = None, typ: str = "Otu") -> DataFrame:
    """Sequences with their unit's total, largest first (ties: input order), id with ``_<total>`` appended.

    With ``relabel`` ids become m<typ><n>_<id>. Units without reads have total 0.
    """
    both = seqs.join(totals.select(F.col("tu_id").alias("id"), "total"), "id", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    ranked = row_number(both, [F.desc("total"), F.asc("ord")], "rank")
    name = F.concat(F.lit(f"m{typ}"), F.col("rank"), F.lit("_"), F.col("id")) if relabel else F.concat_ws("_", "id", F.col("total").cast("string"))
    return ranked.withColumn("label", name)
