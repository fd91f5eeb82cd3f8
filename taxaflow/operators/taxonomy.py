"""Lineages, lowest common ancestors and what is read from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.staging import materialize


#: The eight ranks of a lineage, their prefixes, and the name of what has none.
RANKS = ["domain", "kingdom", "phylum", "class", "order", "family", "genus", "species"]
PREFIXES = ["d__", "k__", "p__", "c__", "o__", "f__", "g__", "s__"]
UNASSIGNED = "k__Unassigned"


def ancestors(nodes: DataFrame, rounds: int = 64) -> DataFrame:
    """(taxid, ancestor, depth) for all nodes (taxid, parent, rank, name), depth 0 being the node itself.

    Paths double in each round (an ancestor's ancestors), so a tree of depth d takes about log2(d) joins.
    """
    paths = nodes.select("taxid", F.col("taxid").alias("ancestor"), F.lit(0).alias("depth")).unionByName(
        nodes.where("parent is not null and parent <> taxid").select("taxid", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")))
    length, last = 1, -1
    for _ in range(rounds):
        paths = materialize(paths, "ancestors")
        n = paths.count()
        if n == last:
            break
        last = n
        far = paths.where(F.col("depth") == length)
        more = far.join(paths.where("depth > 0").select(F.col("taxid").alias("ancestor"), F.col("ancestor").alias("_a"), F.col("depth").alias("_d")), "ancestor")
        more = more.select("taxid", F.col("_a").alias("ancestor"), (F.col("depth") + F.col("_d")).alias("depth"))
        paths = paths.unionByName(more).distinct()
        length *= 2
    known = nodes.select(F.col("taxid").alias("ancestor")).distinct()
    return paths.join(known, "ancestor", "left_semi").select("taxid", "ancestor", "depth")


def clean_name(name: Column) -> Column:
    return F.replace(F.translate(name, " =", "_."), F.lit("'"), F.lit(""))


def fill_ranks(names: list[Column]) -> Column:
    """A lineage of eight prefixed ranks: missing upper ones are Unassigned, lower ones unclassified below the last known."""
    out, last = [], F.lit("Unassigned")
    for i, (prefix, name) in enumerate(zip(PREFIXES, names)):
        own = clean_name(name)
        missing = F.lit("Unassigned") if i < 2 else F.concat(F.lit("unclassified_"), last)
        out.append(F.concat(F.lit(prefix), F.coalesce(own, missing)))
        last = F.coalesce(own, last)
    return F.array(*out)


def lineages(nodes: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """(taxid, lineage) of each node: its nearest named ancestors of the eight ranks; merged ids (old, new) share theirs."""
    up = ancestors(nodes).join(nodes.select(F.col("taxid").alias("ancestor"), "rank", "name"), "ancestor").where(F.col("rank").isin(RANKS))
    at = up.groupBy("taxid").agg(*[F.min_by(F.when(F.col("rank") == r, F.col("name")), F.when(F.col("rank") == r, F.col("depth"))).alias(r) for r in RANKS])
    every = nodes.select("taxid").distinct().join(at, "taxid", "left")
    out = every.select("taxid", fill_ranks([F.col(r) for r in RANKS]).alias("lineage"))
    if merged is not None:
        out = out.unionByName(merged.join(out, F.col("new") == F.col("taxid")).select(F.col("old").alias("taxid"), "lineage"))
    return out


def fold_lca(lines: Column) -> Column:
    """Lineages in order, folded: ranks of the running result that the next one shares at the same place.

    Unclassified ranks of the running result go at each step; a single lineage is returned as it is. A lower rank may
    survive a higher one that differs, and later places shift: the order of the lineages matters.
    """
    agree = lambda a, b: F.filter(F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))), lambda x, y: F.when((x == y) & ~x.contains("__unclassified"), x)), lambda x: x.isNotNull())
    return F.aggregate(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), F.get(lines, F.lit(0)), agree)


def strict_lca(lines: Column, depth: int = len(RANKS)) -> Column:
    """The longest prefix that all lineages share, cut at the first unclassified rank; one lineage stays as it is."""
    same = lambda i: F.size(F.array_distinct(F.transform(lines, lambda x: F.coalesce(F.get(x, i), F.lit(""))))) == 1
    first = F.get(lines, F.lit(0))
    bad = F.filter(F.sequence(F.lit(0), F.lit(depth - 1)), lambda i: ~same(i) | F.coalesce(F.get(first, i).contains("__unclassified"), F.lit(True)))
    stop = F.coalesce(F.get(bad, F.lit(0)), F.lit(depth))
    return F.when(F.size(F.array_distinct(lines)) == 1, first).otherwise(F.slice(first, F.lit(1), stop))


def name_lca(lines: Column, mode: str = "reference") -> Column:
    """The ancestor as text; without a common rank the distinct first ranks joined by _OR_; without lineage unassigned."""
    found = fold_lca(lines) if mode == "reference" else strict_lca(lines)
    tops = F.array_join(F.array_sort(F.array_distinct(F.transform(lines, lambda x: F.get(x, F.lit(0))))), "_OR_")
    return F.when(F.coalesce(F.size(lines), F.lit(0)) <= 0, F.lit(UNASSIGNED)).when(F.size(found) > 0, F.array_join(found, ";")).otherwise(tops)


def assign_lca(top: DataFrame, known: DataFrame, mode: str = "reference") -> DataFrame:
    """(qseqid, taxonomy, bitscore, per_id, per_qcov) from top hits (with hit_ord) and lineages (taxid, lineage)."""
    both = top.join(known, "taxid", "left")
    item = F.when(F.col("lineage").isNotNull(), F.struct("hit_ord", "lineage"))
    g = both.groupBy("qseqid").agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["lineage"]).alias("lines"), F.max("bitscore").alias("bitscore"),
        F.min_by("pident", "hit_ord").alias("per_id"), F.min_by("qcovs", "hit_ord").alias("per_qcov"))
    return g.select("qseqid", name_lca(F.col("lines"), mode).alias("taxonomy"), "bitscore", "per_id", "per_qcov")


def level_counts(tax: DataFrame, column: str = "taxonomy") -> DataFrame:
    """(level, n): how many assignments name each level, or nothing."""
    #: Level labels and the text that marks them.
    levels = {"kingdom": ["k__", "d__"], "phylum": ["p__"], "class": ["c__"], "order": ["o__"], "family": ["f__"], "genus": ["g__"], "species": ["s__"], "subspecies": ["u__"], "unassigned": ["Unassigned"]}
    cond = {name: reduce(lambda a, b: a | b, [F.col(column).contains(m) for m in marks]) for name, marks in levels.items()}
    wide = tax.agg(*[F.count_if(c).alias(n) for n, c in cond.items()])
    return wide.unpivot([], list(levels), "level", "n")


def mixed_families(hits: DataFrame, known: DataFrame, top: int = 10) -> DataFrame:
    """(qseqid, families, mixed): whether the first ``top`` hits of a query name more than one family (taxid, family)."""
    first = hits.withColumn("_i", F.row_number().over(Window.partitionBy("qseqid").orderBy("hit_ord"))).where(F.col("_i") <= top)
    each = first.select("qseqid", F.explode("staxids").alias("taxid")).join(known, "taxid", "left")
    return each.groupBy("qseqid").agg(F.countDistinct("family").alias("families")).withColumn("mixed", F.col("families") > 1)


def family_of(lineage: Column) -> Column:
    return F.get(lineage, F.lit(RANKS.index("family")))


def clean_ids(df: DataFrame, column: str) -> DataFrame:
    """Strips a trailing count from ids, and doubled unclassified from taxonomies if there are any."""
    out = df.withColumn(column, F.regexp_replace(column, r"_[0-9]+$", ""))
    return out.withColumn("taxonomy", F.regexp_replace("taxonomy", "unclassified_unclassified", "unclassified")) if "taxonomy" in df.columns else out


def classify_by_keyword(tax: DataFrame, exact: list[str], partial: list[str], keywords: list[str], column: str = "taxonomy") -> DataFrame:
    """Adds class: solid if the last rank is one of ``exact`` or contains one of ``partial``, putative if the text has a keyword."""
    last = F.element_at(F.split(column, ";"), -1)
    any_ = lambda c, words: reduce(lambda a, b: a | b, [c.contains(w) for w in words], F.lit(False))
    return tax.withColumn("class", F.when(last.isin(exact) | any_(last, partial), "solid").when(any_(F.col(column), keywords), "putative"))


def best_taxids(hits: DataFrame) -> DataFrame:
    """Taxids of a query by (bit score, count, taxid), all descending."""
    per = hits.groupBy("qseqid", "taxid").agg(F.max("bitscore").alias("bitscore"), F.count(F.lit(1)).alias("n"))
    return per.withColumn("place", F.row_number().over(Window.partitionBy("qseqid").orderBy(F.desc("bitscore"), F.desc("n"), F.desc("taxid"))))


