"""Keep or reject units by the classes of the taxids they hit: kept, environmental, rejected, undetermined, none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.operators.hits import valid_taxid

#: Codes that are decided without scores.
KEEP_ALWAYS = ["E", "EK", "EKU", "K", "N"]
REJECT_ALWAYS = ["ER", "ERU", "R", "RU", "U"]


def with_merged(ids: DataFrame, merged: DataFrame) -> DataFrame:
    """Listed taxids and the old ids (old, new) that were merged into them."""
    return ids.select("taxid").unionByName(merged.join(ids, F.col("new") == F.col("taxid"), "left_semi").select(F.col("old").alias("taxid"))).distinct()


def taxid_classes(keep: DataFrame, env: DataFrame, reject: DataFrame) -> DataFrame:
    """(taxid, class): R over E over K where a taxid is in several lists."""
    lists = [(keep, "K", 0), (env, "E", 1), (reject, "R", 2)]
    every = [d.select("taxid", F.lit(c).alias("class"), F.lit(i).alias("i")) for d, c, i in lists]
    return every[0].unionByName(every[1]).unionByName(every[2]).groupBy("taxid").agg(F.max_by("class", "i").alias("class"))


def hit_classes(hits: DataFrame, classes: DataFrame) -> DataFrame:
    """Hits by first taxid with their class; taxids on no list are U, invalid ones are skipped."""
    valid = hits.withColumn("taxid", valid_taxid(F.col("staxids"))).where("taxid is not null")
    return valid.join(classes, "taxid", "left").withColumn("class", F.coalesce("class", F.lit("U")))


def top_by_taxid(classed: DataFrame) -> DataFrame:
    """(qseqid, taxid, class, bitscore, n, title): each taxid's best bit score and how many hits reach it."""
    over = Window.partitionBy("qseqid", "taxid")
    best = classed.withColumn("_b", F.max("bitscore").over(over)).where(F.col("bitscore") == F.col("_b"))
    return best.groupBy("qseqid", "taxid", "class", "bitscore").agg(F.count(F.lit(1)).alias("n"), F.min_by("stitle", "hit_ord").alias("title"), F.min("hit_ord").alias("hit_ord"))


def designate(hits: DataFrame, queries: DataFrame, classes: DataFrame) -> DataFrame:
    """(qseqid, size, initial): the classes a query hits as a sorted code; N without hits, U if no taxid is valid."""
    codes = hit_classes(hits, classes).groupBy("qseqid").agg(F.array_join(F.array_sort(F.collect_set("class")), "").alias("code"))
    seen = hits.select("qseqid").distinct().withColumn("seen", F.lit(True))
    out = queries.join(codes, "qseqid", "left").join(seen, "qseqid", "left")
    return out.withColumn("initial", F.coalesce("code", F.when(F.col("seen"), "U"), F.lit("N"))).drop("code", "seen")


def scores(top: DataFrame, phix: Sequence = ()) -> DataFrame:
    """Per query and class X in E, K, R, U: best score bX, hits at it cX, taxids at it nX; the classes as a sorted code,
    the first U title, and whether one of the taxids ``phix`` is among the R ones at their best score."""
    over = Window.partitionBy("qseqid", "class")
    best = top.withColumn("_b", F.max("bitscore").over(over)).where(F.col("bitscore") == F.col("_b"))
    cols = []
    for c in "EKRU":
        own = F.col("class") == c
        cols += [F.max(F.when(own, F.col("bitscore"))).alias(f"b{c}"), F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"c{c}"), F.count_if(own).alias(f"n{c}")]
    title = F.min_by(F.when(F.col("class") == "U", F.col("title")), F.when(F.col("class") == "U", F.col("hit_ord"))).alias("u_title")
    code = F.array_join(F.array_sort(F.collect_set("class")), "").alias("code")
    phage = F.coalesce(F.bool_or((F.col("class") == "R") & F.col("taxid").isin(list(phix))), F.lit(False)) if phix else F.lit(False)
    return best.groupBy("qseqid").agg(*cols, code, title, phage.alias("phix"))


def decision(code: Column, phix: Column | None = None) -> Column:
    """K or R by code and scores. ``phix`` (a phage taxid is among the rejected best) is off unless given."""
    b, c, n = ({x: F.col(f"{k}{x}") for x in "EKRU"} for k in "bcn")
    phix = F.lit(False) if phix is None else phix
    reject = {
        "EKRU": (b["K"] < b["R"]) | ((b["K"] == b["R"]) & (c["K"] <= c["R"]) & (n["K"] <= n["R"])) | ((b["K"] == b["U"]) & (c["K"] <= c["U"])),
        "EKR": (b["K"] < b["R"]) | ((b["K"] == b["R"]) & (c["K"] <= c["R"])),
        "KR": (b["K"] < b["R"]) | ((b["K"] == b["R"]) & (c["K"] <= c["R"])),
        "EU": ((b["E"] < b["U"]) & ((c["E"] <= c["U"]) | (n["E"] < n["U"]))) | ((b["E"] == b["U"]) & F.coalesce(F.col("u_title").rlike("[Cc]hloroplast"), F.lit(False))),
        "KU": ((b["K"] < b["U"]) & (n["K"] < n["U"])) | ((b["K"] == b["U"]) & (n["K"] <= n["U"])),
        "KRU": (b["K"] < b["R"]) | ((b["K"] <= b["U"]) & phix) | (b["K"] == b["R"]) | (phix & (c["R"] > 2)),
    }
    out = F.when(code.isin(KEEP_ALWAYS), "K").when(code.isin(REJECT_ALWAYS), "R")
    for k, rule in reject.items():
        out = out.when(code == k, F.when(F.coalesce(rule, F.lit(False)), "R").otherwise("K"))
    return out


def keep_reject(hits: DataFrame, queries: DataFrame, classes: DataFrame, phix: Sequence = ()) -> DataFrame:
    """(qseqid, size, initial, final) of every query, with its scores; hits are classified and grouped once.

    ``phix`` are the taxids of the spiked-in phage: with one of them among a query's best rejected ones, KRU rejects more.
    """
    top = scores(top_by_taxid(hit_classes(hits, classes)), phix)
    seen = hits.select("qseqid").distinct().withColumn("seen", F.lit(True))
    both = queries.join(top, "qseqid", "left").join(seen, "qseqid", "left")
    both = both.withColumn("initial", F.coalesce("code", F.when(F.col("seen"), "U"), F.lit("N"))).drop("code", "seen")
    return both.withColumn("final", decision(F.col("initial"), F.coalesce("phix", F.lit(False)))).drop("phix")


def summarize(decided: DataFrame) -> DataFrame:
    """Units, reads and reads per unit by (initial, final), by final, and over all (grouping sets; nulls mean all)."""
    g = decided.groupingSets([["initial", "final"], ["final"], []], "initial", "final").agg(
        F.count(F.lit(1)).alias("units"), F.coalesce(F.sum("size"), F.lit(0)).alias("reads"))
    return g.withColumn("reads_per_unit", F.try_divide("reads", "units"))


def suspicious_accessions(classed: DataFrame, one: int = 1, many: int = 20) -> DataFrame:
    """(accession, class, n): accessions that alone speak for K against more than ``many`` R hits at equal score, or the reverse."""
    best = classed.withColumn("_b", F.max("bitscore").over(Window.partitionBy("qseqid"))).where(F.col("bitscore") == F.col("_b"))
    count = lambda c: F.count_if(F.col("class") == c)
    odd = best.groupBy("qseqid").agg(count("K").alias("k"), count("R").alias("r"))
    odd = odd.where(((F.col("k") == one) & (F.col("r") > many)) | ((F.col("r") == one) & (F.col("k") > many)))
    lone = best.join(odd, "qseqid").where(F.col("class") == F.when(F.col("k") == one, "K").otherwise("R"))
    return lone.groupBy(F.col("sseqid").alias("accession"), "class").agg(F.count(F.lit(1)).alias("n"))


def assign_kept(decided: DataFrame, assigned: DataFrame, min_keep: float = 0.0, min_env: float = 0.0) -> DataFrame:
    """Taxonomy of kept units; rejected ones are marked. Scores below the class's least are unassigned."""
    low = F.when(F.col("bitscore") < F.when(F.col("initial").contains("K"), min_keep).otherwise(min_env), "k__Unassigned")
    both = decided.select("qseqid", "initial", "final").join(assigned, "qseqid", "left")
    return both.withColumn("taxonomy", F.when(F.col("final") == "R", "rejected").otherwise(F.coalesce(low, "taxonomy", F.lit("k__Unassigned"))))
