"""Barcodes that miss the map by a few bases: collisions, rescue and rewriting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.sequence import hamming
from taxaflow.functions.staging import materialize


#: Stands for a masked place, and for one that a shorter barcode lacks.
MASK, GONE = "\x01", "\x02"


def masked(rows: DataFrame, column: str, size: str, most: int) -> DataFrame:
    """A row for each way to mask ``most`` places of the first ``size`` characters, with what is left in ``text``."""
    rows = rows.withColumn("text", F.rpad(F.substring(column, F.lit(1), F.col(size)), F.col(size), F.lit(GONE))).withColumn("_at", F.lit(0))
    for i in range(most, 0, -1):  # i places are still to be masked, each after the one before; barcodes without them are masked whole
        places = F.sequence(F.least(F.col("_at") + 1, F.col(size)), F.greatest(F.col(size) - i + 1, F.least(F.col("_at") + 1, F.col(size))))
        rows = rows.withColumn("_at", F.explode(places)).withColumn("text", F.overlay("text", F.lit(MASK), F.col("_at"), F.lit(1)))
    return rows.drop("_at")


def mismatches(bc: Column, barcode: Column, longest: int) -> Column:
    """``hamming`` as a plain sum over the places of barcodes up to ``longest`` characters."""
    if longest > 64:
        return hamming(bc, barcode)
    return sum(((F.substring(bc, i, 1) != F.substring(barcode, i, 1)) & (F.length(bc) >= i)).cast("int") for i in range(1, longest + 1)) + F.lit(0)


def near_pairs(counts: DataFrame, sample_map: DataFrame, most: int = 2) -> DataFrame:
    """(barcode, n, sample_id, bc, d): every read barcode and map barcode ``bc`` within ``most`` mismatches.

    Such a pair is equal once the right ``most`` places are masked, so candidates come from an equi join on masked
    barcodes, and nearly all of them are pairs. The lengths of the map's barcodes (few) are looked up first: each read
    barcode is compared over these.
    """
    known = sample_map.select("sample_id", F.col("barcode").alias("bc")).where("bc <> ''").withColumn("size", F.length("bc"))
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())
    seen = counts.withColumn("size", F.explode(F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>")))
    pairs = masked(seen, "barcode", "size", most).join(masked(known, "bc", "size", most), ["size", "text"]).select("barcode", "n", "sample_id", "bc").distinct()
    return pairs.withColumn("d", mismatches(F.col("bc"), F.col("barcode"), sizes[-1] if sizes else 0)).where(F.col("d") <= most)


def collisions(counts: DataFrame, sample_map: DataFrame, most: int = 2) -> DataFrame:
    """(barcode, n, d, ties, samples, kind): each read barcode at its least distance from the map.

    kind is bc for exact ones, m<d> if one map barcode is nearest, *<d> if several are. A longer barcode that begins with
    a map barcode is at distance 0. Distances are tried from 0 on, each for the barcodes that have none nearer, so pairs further apart
    than the nearest aren't made.
    """
    left = materialize(counts, "barcode-counts")
    nearest = near = materialize(near_pairs(left, sample_map, 0), "nearest")
    for d in range(1, most + 1):
        left = materialize(left.join(near.select("barcode").distinct(), "barcode", "left_anti"), "farther")
        nearest = nearest.unionByName(near := materialize(near_pairs(left, sample_map, d), "nearest"))
    g = nearest.groupBy("barcode", "n", "d").agg(F.count(F.lit(1)).alias("ties"), F.array_sort(F.collect_list(F.struct("sample_id", "bc"))).alias("samples"))
    kind = F.when(F.col("d") == 0, "bc").when(F.col("ties") == 1, F.concat(F.lit("m"), F.col("d"))).otherwise(F.concat(F.lit("*"), F.col("d")))
    return g.withColumn("kind", kind)


def mismatch_positions(bc, barcode):
    """Zero-based places at which the two differ."""
    places = F.sequence(F.lit(0), F.length(bc) - 1)
    return F.filter(places, lambda i: F.substring(bc, i + 1, F.lit(1)) != F.substring(barcode, i + 1, F.lit(1)))


def order_report(found: DataFrame) -> DataFrame:
    """Report rows with places of mismatch, in order of places (one by one), larger counts first."""
    one = found.where((F.col("ties") == 1) & (F.col("d") > 0))
    return one.withColumn("positions", mismatch_positions(F.col("samples")[0]["bc"], F.col("barcode"))).orderBy("positions", F.desc("n"), "barcode")


def rescue_pairs(found: DataFrame, counts: DataFrame, distances: list[int], keep_larger: bool = False) -> DataFrame:
    """(barcode, bc, sample_id, d): barcodes to rewrite, those with one nearest map barcode at one of the distances.

    Both must be of A, C, G, T, N and of equal length. Without ``keep_larger`` a barcode must be rarer than the one it
    is rewritten to.
    """
    pairs = found.where((F.col("ties") == 1) & F.col("d").isin(distances) & (F.col("d") > 0)).select("barcode", "n", "d", F.col("samples")[0]["bc"].alias("bc"), F.col("samples")[0]["sample_id"].alias("sample_id"))
    pairs = pairs.where((F.length("barcode") == F.length("bc")) & F.col("barcode").rlike("^[ACTGN]+$") & F.col("bc").rlike("^[ACTGN]+$"))
    if not keep_larger:
        perfect = counts.select(F.col("barcode").alias("bc"), F.col("n").alias("pm"))
        pairs = pairs.join(perfect, "bc", "left").where(F.col("n") < F.coalesce("pm", F.lit(0)))
    return pairs.select("barcode", "bc", "sample_id", "d")


def apply_rescue(reads: DataFrame, pairs: DataFrame) -> DataFrame:
    """Reads with rescued barcodes; others stay as they are."""
    return reads.join(pairs.select("barcode", "bc"), "barcode", "left").withColumn("barcode", F.coalesce("bc", "barcode")).drop("bc")


def gain(found: DataFrame) -> DataFrame:
    """(pm, mm, percent): reads of exact barcodes, of rescuable ones, and the second as a percentage of the first."""
    sums = found.agg(F.coalesce(F.sum(F.when(F.col("d") == 0, F.col("n"))), F.lit(0)).alias("pm"), F.coalesce(F.sum(F.when((F.col("d") > 0) & (F.col("ties") == 1), F.col("n"))), F.lit(0)).alias("mm"))
    return sums.withColumn("percent", F.try_divide(F.col("mm") * 100.0, F.col("pm")))
