"""Pairs of sequences within an edit distance, by parts that they must share.

A unit that may have e edits is cut into e + 1 parts, one of which is found unchanged in every sequence within e edits.
Moreover, of those parts some i-th one has at most i - 1 edits before it and e + 1 - i after it, which bounds how far
it can have moved from either end; only these windows of a sequence are looked up. All this holds for parts of any stretch of
the unit too, so each unit whose parts meet many sequences takes them from the stretch in which they meet the fewest: texts that
begin with the same lines are told apart by what follows. Short units of one edit are joined by what is left
when one character is taken out of either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.staging import materialize

#: Stretches that parts may be taken from, in eighths of a unit.
WHOLE = [(0, 8)]
STRETCHES = [(0, 4), (4, 8), (0, 2), (2, 4), (4, 6), (6, 8), (0, 1), (7, 8)]
#: A unit that meets no more windows than this keeps the parts of the whole; parts of stretches have so many characters at least.
FEW, LEAST_PART = 64, 3
#: Units of one edit up to this length are joined by deletions.
SHORT = 64


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _stretch(n: int) -> Column:
    return F.call_function("div", F.col("m") * F.col(f"_s.{'fg'[n]}"), F.lit(8)).cast("int")


def _part_start(i: Column, m: Column, e: Column) -> Column:
    """Where part i (from 0) of a stretch of length m begins, from 0; with more edits than characters all is one empty part."""
    return F.when(e < m, F.call_function("div", m * i, e + 1)).otherwise(F.lit(0)).cast("int")


def _parts(e: Column, m: Column) -> Column:
    return F.sequence(F.lit(0), F.when(e < m, e).otherwise(F.lit(0)))


def _cut(rows: DataFrame, stretches: list[tuple[int, int]]) -> DataFrame:
    """Rows (m, e) once for each part: its number _i, and _a and _w, where it begins and its length, in each stretch _s that is long enough."""
    every = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(g).alias("g")) for f, g in stretches])
    rows = rows.withColumn("_s", F.explode(every)).withColumn("_low", _stretch(0)).withColumn("_n", _stretch(1) - _stretch(0))
    m, e, i = F.col("_n"), F.col("e"), F.col("_i")
    rows = rows.where((F.col("_n") == F.col("m")) | (F.col("_n") >= LEAST_PART * (e + 1))).withColumn("_i", F.explode(_parts(e, m)))
    return rows.withColumn("_a", F.col("_low") + _part_start(i, m, e)).withColumn("_w", _part_start(i + 1, m, e) - _part_start(i, m, e))


def part_keys(units: DataFrame, by: list[str], stretches: list[tuple[int, int]]) -> DataFrame:
    """(u, _s, key) of units (u, seq, e): a hash of each part with its place, the unit's length and edits, and the columns ``by``."""
    split = _cut(units.where("e >= 0").select("u", "seq", "e", *by, F.length("seq").alias("m")), stretches)
    return split.select("u", "_s", F.xxhash64(*by, "m", "e", "_s", "_i", F.substring(F.col("seq"), F.col("_a") + 1, F.col("_w"))).alias("key"))


def shapes_of(units: DataFrame) -> DataFrame:
    """(n, shapes): for each length that a sequence near a unit can have, the units' lengths and edits."""
    shapes = units.where("e >= 0").select(F.length("seq").alias("m"), "e").distinct()
    near = shapes.select(F.explode(F.sequence(F.greatest(F.lit(0), F.col("m") - F.col("e")), F.col("m") + F.col("e"))).alias("n"), F.struct("m", "e").alias("s"))
    return near.groupBy("n").agg(F.collect_list("s").alias("shapes"))


def window_keys(seqs: DataFrame, shapes: DataFrame, by: list[str], stretches: list[tuple[int, int]]) -> DataFrame:
    """(v, key) of sequences (v, seq): the hashes of all windows in which a unit's part can have stayed."""
    each = seqs.withColumn("n", F.length("seq")).join(shapes, "n").select("v", "seq", "n", *by, F.explode("shapes").alias("s"))
    each = _cut(each.select("v", "seq", "n", *by, "s.*"), stretches)
    i, e, more = F.col("_i"), F.col("e"), F.col("n") - F.col("m")
    low = F.greatest(F.col("_a") - i, F.col("_a") + more - (e - i), F.lit(0))
    high = F.least(F.col("_a") + i, F.col("_a") + more + (e - i), F.col("n") - F.col("_w"))
    # Units of one part that stands for all have it at 0, in every sequence.
    low, high = F.when(e < F.col("m"), low).otherwise(F.lit(0)), F.when(e < F.col("m"), high).otherwise(F.lit(0))
    each = each.withColumn("_at", F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))))
    return each.select("v", F.xxhash64(*by, "m", "e", "_s", "_i", F.substring(F.col("seq"), F.col("_at") + 1, F.col("_w"))).alias("key"))


def deletion_keys(rows: DataFrame, key: str, by: list[str]) -> DataFrame:
    """(key, hash) of rows (key, seq): the hashes of the sequence and of what is left without each of its characters."""
    i, seq = F.col("_i"), F.col("seq")
    each = rows.select(key, "seq", *by, F.explode(F.sequence(F.lit(0), F.length("seq"))).alias("_i"))
    left = F.when(i == 0, seq).otherwise(F.concat(F.substring(seq, F.lit(1), i - 1), F.substring(seq, i + 1, F.length("seq"))))
    return each.select(key, F.xxhash64(*by, left).alias("key")).distinct()


def shared_keys(seqs: DataFrame, units: DataFrame, by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(v, key) of sequences (v, seq) and (u, key) of units (u, seq, e), of which a pair within e edits has one in common.

    Both are written down; windows that no unit's part has are left out.
    """
    by = by or []
    seqs, units = seqs.repartition(_tasks(seqs), "v"), units.repartition(_tasks(seqs), "u")  # small rows from which much is made
    short = (F.col("e") == 1) & (F.length("seq") <= SHORT)
    lengths = units.where(short).select(F.explode(F.array(*[F.length("seq") + i for i in (-1, 0, 1)])).alias("_n")).distinct()
    few, long = units.where(short), units.where(~short)
    spots = deletion_keys(seqs.join(lengths, F.length("seq") == F.col("_n"), "left_semi"), "v", by)
    shapes = materialize(shapes_of(long), "shapes")
    whole = materialize(part_keys(long, by, WHOLE), "whole-parts")
    met = lambda windows, parts: windows.join(parts.select("key").distinct(), "key", "left_semi").select("v", "key")
    windows = materialize(met(window_keys(seqs, shapes, by, WHOLE), whole), "whole-windows")
    count = lambda w: w.groupBy("key").agg(F.count(F.lit(1)).alias("_met"))
    costs = lambda parts, w: parts.join(count(w), "key", "left").groupBy("u", "_s").agg(F.coalesce(F.sum("_met"), F.lit(0)).alias("_cost"))
    dear = materialize(costs(whole, windows).where(F.col("_cost") > FEW), "dear-units")
    tried = materialize(part_keys(long.join(dear.select("u"), "u", "left_semi"), by, STRETCHES), "tried-parts")
    others = materialize(met(window_keys(seqs, shapes, by, STRETCHES), tried), "tried-windows")
    best = costs(tried, others).unionByName(dear).groupBy("u").agg(F.min_by("_s", F.struct("_cost", "_s")).alias("_s"))
    left = best.where((F.col("_s.f") != 0) | (F.col("_s.g") != 8))
    parts = whole.join(left.select("u"), "u", "left_anti").select("u", "key").unionByName(tried.join(left, ["u", "_s"], "left_semi").select("u", "key"))
    parts = materialize(parts.unionByName(deletion_keys(few, "u", by)), "parts")
    windows = met(windows.unionByName(others), parts).unionByName(met(spots, parts))
    return materialize(windows, "windows"), parts


def near_pairs(seqs: DataFrame, units: DataFrame, by: list[str] | None = None, allowed: Column | None = None, earlier: bool = False, keys: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(v, u, edits, longest): sequences (v, seq) and units (u, seq, e) of equal ``by`` within e edits, or within ``allowed``, and the longer length.

    ``allowed`` may use length_v, length_u and the other columns as v_<name> and u_<name>; it must not be above e. With
    ``earlier`` only pairs of u before v are wanted. Pairs that share a key (``keys``, see ``shared_keys``, if they are known for these
    sequences and units or for more) are compared once, with a distance that stops at the bound. Hashes that collide only add comparisons.
    """
    by = by or []
    windows, parts = shared_keys(seqs, units, by) if keys is None else keys
    met = windows.join(parts, "key")
    # Pairs are small and dear to compare, so their tasks aren't joined by bytes.
    met = (met.where("u < v") if earlier else met).select("v", "u").repartition(_tasks(seqs), "v").distinct()
    left = seqs.select(*[F.col(c).alias("v" if c == "v" else f"v_{c}") for c in seqs.columns])
    right = units.select(*[F.col(c).alias("u" if c == "u" else f"u_{c}") for c in units.columns])
    both = met.join(left, "v").join(right, "u")
    for c in by:
        both = both.where(F.col(f"v_{c}").eqNullSafe(F.col(f"u_{c}")))
    both = both.withColumn("length_v", F.length("v_seq")).withColumn("length_u", F.length("u_seq"))
    both = both.withColumn("_most", F.least(F.col("u_e"), allowed) if allowed is not None else F.col("u_e")).where("_most >= 0")
    both = both.withColumn("edits", F.call_function("levenshtein", F.col("v_seq"), F.col("u_seq"), F.col("_most").cast("int")))
    return both.where("edits >= 0").select("v", "u", "edits", F.greatest("length_v", "length_u").alias("longest"))
