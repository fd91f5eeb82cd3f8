"""Published tables: annotations, detailed tables, composition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.operators.table import SAMPLE, TU, average_abundance, with_total_row


def add_sequences(table: DataFrame, seqs: DataFrame, strict: bool = True) -> DataFrame:
    """The table with each unit's sequence (id, seq). ``strict`` raises for units without one (an action)."""
    known = seqs.select(F.col("id").alias(TU), F.col("seq").alias("Sequence"))
    if strict and not (lost := table.select(TU).distinct().join(known, TU, "left_anti")).isEmpty():
        raise ValueError(f"units without sequence: {[r[0] for r in lost.limit(5).collect()]}")
    return table.join(known, TU)


def taxonomy_summary(rel: DataFrame, seqs: DataFrame, tax: DataFrame, classifier: DataFrame | None = None) -> DataFrame:
    """(tu_id, Sequence, taxonomy, per_ID, per_qcov[, c_taxonomy, confidence], avg_abun): one row for each unit."""
    out = average_abundance(rel).join(seqs.select(F.col("id").alias(TU), F.concat(F.lit(">"), "id", F.lit("#"), "seq").alias("Sequence")), TU, "left")
    out = out.join(tax.select(F.col("qseqid").alias(TU), "taxonomy", F.col("per_id").alias("per_ID"), "per_qcov"), TU, "left")
    columns = [TU, "Sequence", "taxonomy", "per_ID", "per_qcov"]
    if classifier is not None:
        out = out.join(classifier.select(F.col("id").alias(TU), F.col("taxon").alias("c_taxonomy"), "confidence"), TU, "left")
        columns += ["c_taxonomy", "confidence"]
    return out.select(*columns, "avg_abun")


def flag_mixed(table: DataFrame, mixed: DataFrame) -> DataFrame:
    """Adds mixed (yes or no): whether the unit is listed; counts at the end of listed ids are ignored."""
    listed = mixed.select(F.regexp_replace("qseqid", r"_[0-9]+$", "").alias(TU)).distinct().withColumn("_m", F.lit(True))
    return table.join(listed, TU, "left").withColumn("mixed", F.when(F.col("_m"), "yes").otherwise("no")).drop("_m")


def detailed_long(rel: DataFrame, raw: DataFrame, facts: DataFrame) -> DataFrame:
    """Long form of the detailed table: (tu_id, sample_id, value) with the units' facts, and rows ``nd`` of raw sample totals."""
    totals = with_total_row(raw, "nd").where(F.col(TU) == "nd").select(TU, SAMPLE, F.col("n").cast("double").alias("value"))
    cells = rel.select(TU, SAMPLE, F.col("rel").alias("value"))
    return totals.unionByName(cells).join(facts, TU, "left")


def composition(rel: DataFrame, meta: DataFrame, treatment: str, keep: str | None = None, n: int = 3, mode: str = "average", value: str = "rel", samples: DataFrame | None = None) -> DataFrame:
    """(treatment, taxon, percent): the top taxa of each treatment, the rest as other, scaled to 100.

    Means are over a treatment's samples, absent cells as zeros; samples without treatment (or without a value in
    ``keep``) are left out. ``average`` adds one row set, the equal-weight mean of the treatments, over all treatments'
    top taxa; ``per_treatment`` has a row set for each treatment over its own. Ties go to the lesser taxon. ``rel`` has
    columns taxon, sample_id and ``value``; it may have several rows for a taxon and sample, which needn't be summed before.
    ``samples`` may have the table's samples (sample_id), so that they needn't be found by making all cells of ``rel`` once more.
    """
    known = meta.where(F.col(treatment).isNotNull() & (F.col(keep).isNotNull() if keep else F.lit(True))).select(SAMPLE, F.col(treatment).alias("treatment"))
    both = rel.select("taxon", SAMPLE, F.col(value).alias("v")).join(known, SAMPLE)
    sizes = (rel if samples is None else samples).select(SAMPLE).distinct().join(known, SAMPLE).groupBy("treatment").agg(F.count(F.lit(1)).alias("_n"))
    means = both.groupBy("treatment", "taxon").agg(F.sum("v").alias("s")).join(sizes, "treatment").select("treatment", "taxon", (F.col("s") / F.col("_n")).alias("mean"))
    ranked = means.withColumn("_i", F.row_number().over(Window.partitionBy("treatment").orderBy(F.desc(F.round("mean", 12)), "taxon")))
    tops = ranked.where(F.col("_i") <= n)
    if mode == "average":
        count = sizes.agg(F.count(F.lit(1)).alias("_t"))
        means = means.groupBy("taxon").agg(F.sum("mean").alias("s")).crossJoin(F.broadcast(count)).select(F.lit("average").alias("treatment"), "taxon", (F.col("s") / F.col("_t")).alias("mean"))
        named = means.join(tops.select("taxon").distinct().withColumn("top", F.lit(True)), "taxon", "left")
    else:
        named = means.join(tops.select("treatment", "taxon", F.lit(True).alias("top")), ["treatment", "taxon"], "left")
    rows = named.groupBy("treatment", F.when(F.col("top"), F.col("taxon")).otherwise("other").alias("taxon")).agg(F.sum("mean").alias("mean"))
    total = rows.groupBy("treatment").agg(F.sum("mean").alias("_all"))
    return rows.join(total, "treatment").select("treatment", "taxon", F.try_divide(F.col("mean") * 100.0, F.col("_all")).alias("percent"))


def order_composition(rows: DataFrame) -> DataFrame:
    """Taxa by their share in the first treatment, largest first, other last."""
    first = rows.agg(F.min("treatment").alias("_t"))
    by = rows.join(F.broadcast(first), F.col("treatment") == F.col("_t")).select("taxon", F.col("percent").alias("_p"))
    return rows.join(by, "taxon", "left").orderBy(F.col("taxon") == "other", F.desc("_p"), "taxon", "treatment").drop("_p")


def label_ids(table: DataFrame, labels: DataFrame, column: str = TU) -> DataFrame:
    """Prefixes ids that are labelled (id, label) in a column: ``<label>-<id>``. Of an id's labels the least one is taken."""
    known = labels.groupBy(F.col("id").alias(column)).agg(F.min("label").alias("label"))
    return table.join(known, column, "left").withColumn(column, F.concat_ws("-", "label", column)).drop("label")


def label_cells(table: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``label_ids`` in every string column (or those given): cells that equal a listed id get its label before them."""
    for c in columns or [n for n, kind in table.dtypes if kind == "string"]:
        table = label_ids(table, labels, c)
    return table


#: Column names and id prefixes of other programs and what tables call them here.
HEADERS = {"#OTU": "#ASV", "#OTU ID": "#ASV ID", "Feature ID": "#OTU ID", "Taxon": "taxonomy"}
PREFIXES = {"Zotu": "Asv"}


def rename_headers(table: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    return table.withColumnsRenamed(HEADERS if names is None else names)


def rename_ids(column: Column) -> Column:
    """Ids with the prefixes of other programs replaced."""
    for old, new in PREFIXES.items():
        column = F.regexp_replace(column, f"^{old}", new)
    return column


def general(x: Column) -> Column:
    """A number with six significant digits, without zeros at its end, as C's ``%g`` writes it (numbers whose
    shortest decimal form lies half way between two are rounded up)."""
    x = x.cast("double")
    exact = F.format_string("%.5e", x)
    power = F.regexp_extract(exact, "e([+-][0-9]+)$", 1).cast("int")
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    fixed = bare(exact.try_cast("decimal(38,18)").cast("string"))
    written = F.when((power >= -4) & (power < 6), fixed).otherwise(F.concat(bare(F.regexp_extract(exact, "^([^e]*)", 1)), F.regexp_extract(exact, "(e.*)$", 1)))
    odd = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").when(x == 0, "0")
    return F.when(x.isNotNull(), F.coalesce(odd, written))


def rendered(vector: Column) -> Column:
    """An array of numbers as text, joined by commas."""
    return F.array_join(F.transform(vector, general), ",", "nan")
