"""The feature table: long (tu_id, sample_id, n), absent cells are zeros. Totals, ratios, arithmetic, filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.ordering import row_number
from taxaflow.functions.staging import materialize

TU, SAMPLE = "tu_id", "sample_id"
#: Cells of a grid that a task makes, about.
CELLS_OF_TASK = 1 << 24


def count_table(pairs: DataFrame) -> DataFrame:
    """Counts of (tu_id, sample_id) pairs, one row for each read."""
    return pairs.groupBy(TU, SAMPLE).agg(F.count(F.lit(1)).alias("n"))


def wide(ft: DataFrame, samples: list[str], value: str = "n", fill=0) -> DataFrame:
    """One row for each unit and one column for each of the given samples (a boundary format)."""
    return ft.groupBy(TU).pivot(SAMPLE, samples).agg(F.first(value)).na.fill(fill, samples)


def long(table: DataFrame, samples: list[str], key: str = TU, value: str = "n", zeros: bool = False) -> DataFrame:
    out = table.unpivot(key, samples, SAMPLE, value).withColumnRenamed(key, TU)
    return out if zeros else out.where(F.col(value) != 0)


def totals_by_unit(ft: DataFrame, value: str = "n") -> DataFrame:
    return ft.groupBy(TU).agg(F.sum(value).alias("total"))


def totals_by_sample(ft: DataFrame, value: str = "n") -> DataFrame:
    return ft.groupBy(SAMPLE).agg(F.sum(value).alias("total"))


def with_total_row(ft: DataFrame, label: str = "nd", value: str = "n") -> DataFrame:
    """The table with a row of sample totals."""
    totals = totals_by_sample(ft, value).select(F.lit(label).alias(TU), SAMPLE, F.col("total").alias(value))
    return totals.unionByName(ft.select(TU, SAMPLE, value))


def summarize_samples(ft: DataFrame) -> DataFrame:
    """Units and reads of each sample."""
    return ft.groupBy(SAMPLE).agg(F.count_if(F.col("n") > 0).alias("units"), F.sum("n").alias("total"))


def normalize(ft: DataFrame, value: str = "n", name: str = "rel") -> DataFrame:
    """Shares of the sample's total; cells of an all-zero sample are 0.

    Totals are summed map-side and joined back, so one large sample doesn't gather in one task.
    """
    totals = totals_by_sample(ft, value).withColumnRenamed("total", "_total")
    share = F.when(F.col("_total") != 0, F.col(value) / F.col("_total")).otherwise(0.0)
    return ft.join(totals, SAMPLE).withColumn(name, share).drop("_total")


def multiply(ft: DataFrame, by: float, value: str = "n") -> DataFrame:
    """Cells times a constant, rounded half to even."""
    return ft.withColumn(value, F.rint(F.col(value) * by))


def divide(ft: DataFrame, by: float, value: str = "n") -> DataFrame:
    return ft.withColumn(value, F.col(value) / by)


def divide_by_list(ft: DataFrame, divisors: DataFrame, value: str = "n", check: bool = False) -> DataFrame:
    """Cells over their unit's divisor (tu_id, divisor); units without one become 0.

    ``check`` raises where a listed unit isn't in the table (an action).
    """
    if check and not (missing := divisors.join(ft.select(TU).distinct(), TU, "left_anti")).isEmpty():
        raise ValueError(f"divisors for units that the table lacks: {[r[0] for r in missing.select(TU).limit(5).collect()]}")
    out = ft.join(divisors, TU, "left")
    return out.withColumn(value, F.coalesce(F.col(value) / F.col("divisor"), F.lit(0.0))).drop("divisor")


def dense(ft: DataFrame, units: DataFrame | None = None, samples: DataFrame | None = None, value: str = "n") -> DataFrame:
    """Every (unit, sample) cell, zeros included. The grid is the result's size, so filter units and samples before."""
    units = (ft if units is None else units).select(TU).distinct()
    samples = (ft if samples is None else samples).select(SAMPLE).distinct()
    return units.crossJoin(samples).join(ft.select(TU, SAMPLE, value), [TU, SAMPLE], "left").na.fill(0, [value])


def with_pseudocount(ft: DataFrame, pseudocount: float = 1.0, value: str = "n", name: str = "rel", block: int = 1024, digits: int | None = None) -> DataFrame:
    """Shares, rounded to ``digits``, after adding a constant to every cell of the dense grid.

    A sample's total follows from its own cells and the number of units, so the grid is only made, never summed. Nor is it shuffled: samples
    go in blocks that all tasks have, and a unit gets the cells that it lacks from these. What such a cell has is the same for all units, so it
    is computed once for each sample. Units are dealt to tasks by the rows that become of them, since they are few bytes themselves.
    """
    ft = materialize(ft.select(TU, SAMPLE, F.coalesce(value, F.lit(0).cast(dict(ft.dtypes)[value])).alias(value)), "cells")
    kind = dict(ft.dtypes)[value]
    units = ft.agg(F.countDistinct(TU)).first()[0]
    totals = totals_by_sample(ft, value).where(F.col(SAMPLE).isNotNull()).select(SAMPLE, (F.col("total") + F.lit(units * pseudocount)).alias("_total"))
    places = row_number(totals, [F.col(SAMPLE).asc()], "_i").select(SAMPLE, "_total", F.expr(f"cast((_i - 1) div {block} as int)").alias("_b"), F.expr(f"cast((_i - 1) % {block} as int)").alias("_at"))
    places = materialize(places, "sample-places")
    samples = places.count()
    exact = lambda n: F.when(F.col("_total") != 0, (n + F.lit(pseudocount)) / F.col("_total")).otherwise(0.0)
    share = lambda n: exact(n) if digits is None else F.round(exact(n), digits)
    zero = F.lit(0).cast(kind)
    blocks = materialize(places.groupBy("_b").agg(F.collect_list(F.struct("_at", SAMPLE, share(zero).alias("_share"))).alias("_s")), "sample-blocks")
    cells = ft.join(places, SAMPLE).select(TU, SAMPLE, value, share(F.col(value)).alias(name))
    own = ft.join(places, SAMPLE, "left").groupBy(TU, "_b").agg(F.collect_list("_at").alias("_own"))
    own = own.groupBy(TU).agg(F.map_from_entries(F.collect_list(F.when(F.col("_b").isNotNull(), F.struct("_b", "_own")))).alias("_of"))
    tasks = max(int(ft.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-units * samples // CELLS_OF_TASK))
    rows = own.select(TU, "_of", F.explode(F.sequence(F.lit(0), F.lit((samples - 1) // block))).alias("_b")).select(TU, "_b", F.try_element_at("_of", "_b").alias("_own"))
    rows = rows.repartition(tasks, TU, "_b").join(F.broadcast(blocks), "_b").select(TU, "_own", F.explode("_s").alias("_c"))
    rows = rows.where(~F.coalesce(F.array_contains("_own", F.col("_c._at")), F.lit(False)))
    return cells.unionByName(rows.select(TU, F.col(f"_c.{SAMPLE}").alias(SAMPLE), zero.alias(value), F.col("_c._share").alias(name)))


def average_abundance(rel: DataFrame, value: str = "rel", name: str = "avg_abun") -> DataFrame:
    """Mean share of each unit over all samples, zeros included."""
    samples = rel.agg(F.countDistinct(SAMPLE).alias("_n"))
    return rel.groupBy(TU).agg(F.sum(value).alias("_sum")).crossJoin(F.broadcast(samples)).select(TU, (F.col("_sum") / F.col("_n")).alias(name))


def max_depth(ft: DataFrame, value: str = "n") -> DataFrame:
    """The deepest subsampling that every sample allows: the least total of cells cut to integers."""
    per = ft.groupBy(SAMPLE).agg(F.sum(F.col(value).cast("bigint")).alias("total"))
    return per.agg(F.min("total").alias("max_depth"))


def merge(*tables: DataFrame) -> DataFrame:
    """Tables under one another; samples that a table lacks are zeros, which the long form leaves out."""
    return reduce(lambda a, b: a.unionByName(b), [t.select(TU, SAMPLE, "n") for t in tables])


def with_taxon(ft: DataFrame, lineages: DataFrame, level: int, value: str = "n") -> DataFrame:
    """(taxon, sample_id, value): cells by the first ``level`` ranks of their unit's lineage (tu_id, lineage array), not summed;
    units without lineage are unassigned.

    Lineages are shuffled to the cells: files of them may be small enough for a broadcast that is large in each task's memory.
    """
    taxa = lineages.select(TU, F.array_join(F.slice("lineage", 1, level), ";").alias("taxon"))
    return ft.join(taxa.hint("merge"), TU, "left").select(F.coalesce("taxon", F.lit("k__Unassigned")).alias("taxon"), SAMPLE, value)


def collapse(ft: DataFrame, lineages: DataFrame, level: int, value: str = "n") -> DataFrame:
    """Sums by the first ``level`` ranks of the lineage (tu_id, lineage array); units without lineage are unassigned."""
    return with_taxon(ft, lineages, level, value).groupBy("taxon", SAMPLE).agg(F.sum(value).alias(value))


def keep_units(ft: DataFrame, units: DataFrame) -> DataFrame:
    return ft.join(units.select(TU).distinct(), TU, "left_semi")


def drop_units(ft: DataFrame, units: DataFrame) -> DataFrame:
    return ft.join(units.select(TU).distinct(), TU, "left_anti")


def matching_taxa(tax: DataFrame, patterns: list[str], column: str = "taxonomy") -> DataFrame:
    """Units whose taxonomy matches one of the patterns (regular expressions, case ignored)."""
    found = F.col(column).rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)
    return tax.where(found)


def exclude_taxa(ft: DataFrame, tax: DataFrame, patterns: list[str], column: str = "taxonomy") -> DataFrame:
    return drop_units(ft, matching_taxa(tax, patterns, column))


def domain_of(taxonomy: Column, domains: tuple[str, ...] = ("Archaea", "Bacteria", "Eukaryota")) -> Column:
    out = F.lit(None).cast("string")
    for d in reversed(domains):
        out = F.when(taxonomy.startswith(f"d__{d}"), F.lit(d)).otherwise(out)
    return out


def split_domains(ft: DataFrame, tax: DataFrame, domains: tuple[str, ...] = ("Archaea", "Bacteria", "Eukaryota"), renormalize: bool = False) -> dict[str, DataFrame]:
    """One table for each domain at the start of the taxonomy."""
    both = ft.join(tax.select(TU, domain_of(F.col("taxonomy"), domains).alias("_domain")), TU)
    parts = {d: both.where(F.col("_domain") == d).drop("_domain") for d in domains}
    return {d: normalize(t, t.columns[2], t.columns[2]) for d, t in parts.items()} if renormalize else parts


def rank_units(ft: DataFrame, prefix: str = "", first: str = "first") -> DataFrame:
    """Units by total, largest first (ties: by id), with running labels."""
    ranked = row_number(totals_by_unit(ft), [F.desc("total"), F.asc(TU)], "rank")
    return ranked.withColumn("label", F.concat(F.lit(prefix), F.col("rank").cast("string")))


def add_metadata(ft: DataFrame, meta: DataFrame) -> DataFrame:
    return ft.join(meta, TU, "left")


def only_samples(ft: DataFrame, meta: DataFrame, column: str | None = None) -> DataFrame:
    """Cells of samples that the metadata lists (with a value in ``column``)."""
    known = meta if column is None else meta.where(F.col(column).isNotNull())
    return ft.join(known.select(SAMPLE).distinct(), SAMPLE, "left_semi")


def check_raw_counts(ft: DataFrame, value: str = "n") -> None:
    """Raises unless cells are counts: not negative, whole, and samples don't all sum to 1 or 100 (an action)."""
    cell = F.col(value).cast("double")
    sums = ft.groupBy(SAMPLE).agg(F.sum(cell).alias("s"), F.min(cell).alias("low"), F.max(F.abs(cell - F.rint(cell))).alias("frac"))
    r = sums.agg(F.min("low").alias("low"), F.max("frac").alias("frac"), F.max(F.abs(F.col("s") - 1)).alias("one"), F.max(F.abs(F.col("s") - 100)).alias("hundred")).first()
    if r["low"] is not None and (r["low"] < 0 or r["frac"] > 0 or r["one"] <= 1e-3 or r["hundred"] <= 1e-2):
        raise ValueError("raw counts are needed: whole, not negative, and not shares or percentages")
