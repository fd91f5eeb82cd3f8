"""Reads to units by similarity, and strategies that build on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.staging import materialize
from taxaflow.operators import cluster
from taxaflow.operators.cluster import ByIdentity
from taxaflow.operators.derep import label_in_groups, merge_identical, uniques
from taxaflow.operators.near import near_pairs
from taxaflow.operators.table import count_table


def map_sequences(found: DataFrame, units: DataFrame, identity: float = 0.97) -> DataFrame:
    """(seq, tu_id, identity): for each distinct sequence its best unit (id, seq, ord) of at least that identity.

    Equal sequences are joined first; for the rest edits are counted where a part of the unit is shared (see ``near``). Ties go to the
    earlier unit.
    """
    found = found.select("seq").distinct()
    units = units.select(F.col("id").alias("tu_id"), "seq", "ord")
    rule, number = ByIdentity(identity), F.monotonically_increasing_id()
    own = materialize(units.groupBy("seq").agg(F.min(F.struct("ord", "tu_id")).alias("_u")).select(number.alias("u"), "seq", "_u.*"), "units")
    exact = found.join(own, "seq").select("seq", "tu_id", F.lit(1.0).alias("identity"))
    rest = materialize(found.join(own, "seq", "left_anti").withColumn("v", number), "unequal")
    pairs = near_pairs(rest, own.select("u", "seq", rule.most(1).alias("e")), allowed=rule.allowed())
    scored = pairs.withColumn("identity", 1 - F.col("edits") / F.col("longest")).join(own.select("u", "tu_id", "ord"), "u")
    best = scored.groupBy("v").agg(F.min_by(F.struct("tu_id", "identity"), F.struct((-F.col("identity")).alias("i"), F.col("ord").alias("o"))).alias("b"))
    return materialize(exact.unionByName(best.join(rest, "v").select("seq", "b.*")), "mapped")


def map_reads(reads: DataFrame, units: DataFrame, identity: float = 0.97) -> DataFrame:
    """(read_id, sample_id, tu_id, identity) of every read that maps; distinct sequences are compared once."""
    best = map_sequences(reads.select("seq"), units, identity)
    return reads.join(best, "seq").select("read_id", "sample_id", "tu_id", "identity")


def map_to_own_units(reads: DataFrame, identity: float = 0.97) -> DataFrame:
    """(read_id, sample_id, tu_id, identity) of every read: ``map_reads`` to the units that the reads' own uniques make.

    Sequences and units are those that were clustered, so the keys by which near ones are found are made once for both.
    """
    rule = ByIdentity(identity)
    every = cluster.numbered(uniques(reads))
    windows, parts = keys = cluster.keys_of(every, rule, 1)
    units = cluster.centroids(cluster.cluster(every, identity, keys=keys)).select(F.col("ord").alias("u"), "seq", F.col("id").alias("tu_id"))
    units = materialize(units, "units")
    rest = materialize(every.select(F.col("ord").alias("v"), "seq").join(units.select(F.col("u").alias("v")), "v", "left_anti"), "unequal")
    some = windows.join(rest.select("v"), "v", "left_semi"), parts.join(units.select("u"), "u", "left_semi")
    pairs = near_pairs(rest, units.select("u", "seq", rule.most(1).alias("e")), allowed=rule.allowed(), keys=some)
    best = pairs.groupBy("v").agg(F.min_by(F.struct("u", (1 - F.col("edits") / F.col("longest")).alias("identity")), F.struct(F.col("edits") / F.col("longest"), "u")).alias("b")).select("v", "b.*")
    near = rest.join(best, "v").join(units.select("u", "tu_id"), "u").select("seq", "tu_id", "identity")
    mapped = materialize(units.select("seq", "tu_id", F.lit(1.0).alias("identity")).unionByName(near), "mapped")
    return reads.join(mapped, "seq").select("read_id", "sample_id", "tu_id", "identity")


def unbinned(reads: DataFrame, report: DataFrame) -> DataFrame:
    return reads.join(report.select("read_id"), "read_id", "left_anti")


def reads_of_units(report: DataFrame, units: DataFrame) -> DataFrame:
    """Rows of the mapping report for the listed units."""
    return report.join(units.select("tu_id").distinct(), "tu_id", "left_semi")


def table_from(report: DataFrame) -> DataFrame:
    return count_table(report)


def seeds_by_group(reads: DataFrame, sample_map: DataFrame, column: str, make, prefix: str = "Otu") -> DataFrame:
    """Seeds of each group of samples, ids with column and group, equal ones merged; groups go in order of their names.

    ``make`` turns the uniques of all groups (group, seq, size) into centroids (group, id, seq, ord), group by group but
    in one plan (see ``by`` in ``cluster``).
    """
    own = reads.join(sample_map.where(F.col(column).isNotNull()).select("sample_id", F.col(column).alias("group")), "sample_id")
    seeds = make(uniques(own, 1, "group"))
    seeds = seeds.select(F.concat_ws("_", "id", F.lit(column), F.col("group").cast("string")).alias("id"), "seq", F.struct(F.col("group").alias("g"), F.col("ord").alias("o")).alias("ord"))
    return merge_identical(seeds)


def uniques_by_group(reads: DataFrame, sample_map: DataFrame, column: str) -> DataFrame:
    """(group, id, seq, size): labelled uniques of each group."""
    own = reads.join(sample_map.where(F.col(column).isNotNull()).select("sample_id", F.col(column).alias("group")), "sample_id")
    return label_in_groups(uniques(own, 1, "group"), "group")


def known_then_new(reads: DataFrame, filtered: DataFrame, known: DataFrame, make, identity: float = 0.97, known_identity: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Maps reads to known units first; the rest's uniques make new units (UB_ ids), to which they are mapped.

    Returns the merged count table and the units. ``filtered`` are the quality-filtered reads that seeds come from.
    """
    first = map_reads(reads, known, known_identity or identity)
    rest, seeds = unbinned(reads, first), unbinned(filtered, first)
    new = make(uniques(seeds)).withColumn("id", F.concat(F.lit("UB_"), F.col("id")))
    second = map_reads(rest, new, identity)
    both = count_table(first).unionByName(count_table(second))
    return both, known.select("id", "seq").unionByName(new.select("id", "seq"))
