"""Greedy clustering and denoising of unique sequences, exactly as a serial pass in order of size would do it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.ordering import row_number
from taxaflow.functions.staging import materialize
from taxaflow.operators.derep import label_in_groups
from taxaflow.operators.near import near_pairs, shared_keys

#: A batch is the first 4^-i of the undecided sequences, i the least that holds its candidate pairs in bounds.
STEPS = 12


class ByIdentity:
    """A sequence joins the first centroid of at least this identity (1 - edits / the longer length)."""

    def __init__(self, identity: float):
        self.identity = identity

    def most(self, least_size: int) -> Column:
        """Edits that a centroid (seq, size) can have from any sequence that joins it."""
        return F.floor(F.length("seq") / F.lit(self.identity) * (1 - self.identity) + 1e-9).cast("int")

    def allowed(self) -> Column:
        return F.floor((1 - self.identity) * F.greatest("length_v", "length_u") + 1e-9).cast("int")


class BySkew:
    """A sequence joins the first centroid whose size explains it as noise: ratio at most 1 / 2^(alpha * edits + 1)."""

    def __init__(self, alpha: float = 2.0):
        self.alpha = alpha

    def _edits(self, size: Column, smaller: Column) -> Column:
        return F.when(size >= 2 * smaller, F.floor((F.log2(size / smaller) - 1) / self.alpha + 1e-9).cast("int")).otherwise(-1)

    def most(self, least_size: int) -> Column:
        return self._edits(F.col("size"), F.lit(least_size))

    def allowed(self) -> Column:
        return self._edits(F.col("u_size"), F.col("v_size"))


def first_independent(vertices: DataFrame, edges: DataFrame, tail: int = 200_000) -> DataFrame:
    """(ord) of those that a serial pass makes centroids: vertices without an earlier neighbour that is one.

    ``edges`` lists (v, u), u the earlier one. A round makes all vertices centroids that have no earlier undecided neighbour,
    and decides the neighbours after them; the edges of what is decided go. Rounds are logarithmic in number for orders without
    long chains. Once no more than ``tail`` edges are left, one task walks them in order, which ends chains.
    """
    sources = edges.select(F.col("v").alias("ord")).distinct()
    found = [fresh := vertices.select("ord").join(sources, "ord", "left_anti")]
    left = edges
    while (n := left.count()) > tail:
        fresh = materialize(fresh, "centroids")
        members = materialize(left.join(fresh, left["u"] == fresh["ord"], "left_semi").select(F.col("v").alias("ord")).distinct(), "members")
        waiting = left.select(F.col("v").alias("ord")).distinct().join(members, "ord", "left_anti")
        for c in ("v", "u"):
            left = left.join(members.select(F.col("ord").alias(c)), c, "left_anti")
        left = materialize(left.select("v", "u"), "edges")
        found.append(fresh := waiting.join(left.select(F.col("v").alias("ord")).distinct(), "ord", "left_anti"))

    def walk(t: pa.Table) -> pa.Table:
        before: dict = {}
        for v, u in zip(t["v"].to_pylist(), t["u"].to_pylist()):
            before.setdefault(v, []).append(u)
        joined: set = set()
        for v in sorted(before):
            if any(u not in joined for u in before[v]):
                joined.add(v)
        return pa.table({"ord": pa.array([v for v in before if v not in joined], pa.int64())})

    if n:
        found.append(left.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(walk, "ord long"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _batch_end(windows: DataFrame, parts: DataFrame, low: int, high: int, pairs: int) -> int:
    """The last ord of the longest prefix (of a power of 1/4) whose candidate pairs are at most ``pairs``.

    Candidates are counted by key, without making them: sequences that share a part may be many.
    """
    step = F.least(F.lit(STEPS), F.floor(F.log(4.0, (high - low + 1) / (F.col("_o") - low + 1.0)) + 1e-9)).cast("int")
    both = parts.select("key", F.col("u").alias("_o"), F.lit(1).alias("_p"), F.lit(0).alias("_w")).unionByName(windows.select("key", F.col("v").alias("_o"), F.lit(0).alias("_p"), F.lit(1).alias("_w")))
    counts = both.withColumn("_step", step).groupBy("key", "_step").agg(F.sum("_p").alias("_p"), F.sum("_w").alias("_w"))
    upto = [F.sum(F.when(F.col("_step") >= i, F.col(c)).otherwise(0)).alias(f"{c}{i}") for i in range(STEPS + 1) for c in ("_p", "_w")]
    sums = counts.groupBy("key").agg(*upto).agg(*[F.sum(F.col(f"_p{i}").cast("double") * F.col(f"_w{i}")).alias(f"n{i}") for i in range(STEPS + 1)]).first()
    i = next((i for i in range(STEPS + 1) if (sums[f"n{i}"] or 0) <= pairs), STEPS)
    return low - 1 + max(1, int((high - low + 1) / 4**i))


def numbered(found: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """(by..., seq, size, ord): uniques in order of size, then text."""
    by = list(by)
    order = [F.desc("size"), F.asc("seq"), *[F.asc(c) for c in by]]
    return materialize(row_number(found.select(*by, "seq", "size"), order, "ord"), "uniques")


def keys_of(left: DataFrame, rule, least: int, by: list[str] | tuple = ()) -> tuple[DataFrame, DataFrame]:
    """The keys (v, key) and (u, key) of numbered uniques, each as a sequence and as a unit (see ``near``)."""
    return shared_keys(left.withColumnRenamed("ord", "v"), left.withColumn("e", rule.most(least)).withColumnRenamed("ord", "u"), list(by))


def greedy(found: DataFrame, rule, prefix: str = "Otu", by: list[str] | tuple = (), pairs_per_sequence: int = 64, least_pairs: int = 1 << 24, tail: int = 200_000, keys: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(by..., seq, size, ord, centroid, centroid_ord, tu_id): every unique with the centroid it joins, or is.

    Sequences go in order of size (then text), in each group of ``by`` on their own; all groups are dealt with at once.
    A prefix of the undecided ones, as long as their candidate pairs stay in proportion to them (``pairs_per_sequence``, ``least_pairs`` in all), is
    decided by the graph of its neighbours; its centroids then take what joins them of the rest, and the next prefix follows. So
    large groups of near copies leave by their first member and are never compared pair by pair. With ``keys``, the
    ``keys_of`` it, ``found`` is a table of ``numbered``.
    """
    by = list(by)
    every = left = numbered(found, by) if keys is None else found
    parts = []
    while True:
        n, low, high, least = left.agg(F.count(F.lit(1)), F.min("ord"), F.max("ord"), F.min("size")).first()
        if not n:
            break
        e = rule.most(least)
        seqs, units = left.withColumnRenamed("ord", "v"), left.withColumn("e", e).withColumnRenamed("ord", "u")
        (windows, shared), keys = keys or keys_of(left, rule, least, by), None  # later rounds have fewer sequences
        end = _batch_end(windows, shared, low, high, max(least_pairs, pairs_per_sequence * n))
        head = left.where(F.col("ord") <= end)
        near = lambda v, u, **o: near_pairs(seqs.where(v), units.where(u), by, rule.allowed(), keys=(windows.where(v), shared.where(u)), **o)  # noqa: B023, E731
        edges = materialize(near(F.col("v") <= end, F.col("u") <= end, earlier=True).select("v", "u"), "edges")
        centres = materialize(first_independent(head, edges.select("v", "u"), tail), "centroids")
        own = edges.join(centres.select(F.col("ord").alias("u")), "u", "left_semi").join(centres.select(F.col("ord").alias("v")), "v", "left_anti")
        parts += [centres.select("ord", F.col("ord").alias("centroid_ord")), own.groupBy(F.col("v").alias("ord")).agg(F.min("u").alias("centroid_ord"))]
        if end >= high:
            break
        rest = left.where(F.col("ord") > end)
        chosen = centres.select(F.col("ord").alias("u"))
        taken = near_pairs(seqs.where(F.col("v") > end), units.join(chosen, "u", "left_semi"), by, rule.allowed(), keys=(windows.where(F.col("v") > end), shared.join(chosen, "u", "left_semi")))
        parts.append(taken := materialize(taken.groupBy(F.col("v").alias("ord")).agg(F.min("u").alias("centroid_ord")), "taken"))
        left = materialize(rest.join(taken, "ord", "left_anti"), "undecided")
    if not parts:
        return every.withColumns({"centroid": F.col("seq"), "centroid_ord": F.col("ord"), "tu_id": F.lit("")}).select(*by, "seq", "size", "ord", "centroid", "centroid_ord", "tu_id")
    joins = parts[0]
    for p in parts[1:]:
        joins = joins.unionByName(p)
    centres = joins.where("ord = centroid_ord").select("ord").join(every, "ord")
    if by:  # numbers within each group
        key = F.struct(*by)
        every = label_in_groups(every.withColumn("_key", key).withColumnRenamed("ord", "_ord"), "_key").select(*by, "seq", "size", "_ord", F.col("ord").cast("long").alias("ord"))
        named = label_in_groups(centres.withColumn("_key", key).withColumnRenamed("ord", "_ord"), "_key", prefix).select(F.col("_ord").alias("_c"), F.col("seq").alias("centroid"), F.col("id").alias("tu_id"))
        named = named.join(every.select(F.col("_ord").alias("_c"), F.col("ord").alias("centroid_ord")), "_c")
    else:
        every = every.withColumn("_ord", F.col("ord"))
        named = row_number(centres, [F.col("ord").asc()], "_n").select(F.col("ord").alias("_c"), F.col("seq").alias("centroid"), F.concat(F.lit(prefix), F.col("_n").cast("string")).alias("tu_id"), F.col("ord").alias("centroid_ord"))
    joins = joins.select(F.col("ord").alias("_ord"), F.col("centroid_ord").alias("_c"))
    return every.join(joins, "_ord").join(named, "_c").select(*by, "seq", "size", "ord", "centroid", "centroid_ord", "tu_id")


def cluster(found: DataFrame, identity: float = 0.97, least: int = 1, **options) -> DataFrame:
    return greedy(found.where(F.col("size") >= least), ByIdentity(identity), **options)


def denoise(found: DataFrame, alpha: float = 2.0, least: int = 8, prefix: str = "Asv", **options) -> DataFrame:
    return greedy(found.where(F.col("size") >= least), BySkew(alpha), prefix=prefix, **options)


def centroids(clustered: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """(by..., id, seq, size, ord): the units' sequences with the reads of all members."""
    g = clustered.groupBy(*by, "tu_id", "centroid", "centroid_ord").agg(F.sum("size").alias("size"))
    return g.select(*by, F.col("tu_id").alias("id"), F.col("centroid").alias("seq"), "size", F.col("centroid_ord").alias("ord"))
