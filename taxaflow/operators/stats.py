"""Rank correlations, fold changes and their significance."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.ordering import adjust_bh, row_number
from taxaflow.functions.probability import norm_pvalue, t_pvalue
from taxaflow.functions.staging import materialize
from taxaflow.operators.table import SAMPLE, TU


def average_rank(value: str, *by: str) -> Column:
    """Ranks within groups; ties share the mean of their places."""
    over = Window.partitionBy(*by).orderBy(value)
    ties = Window.partitionBy(*by, value)
    return F.rank().over(over) + (F.count(F.lit(1)).over(ties) - 1) / 2.0


def pearson(a: str, b: str) -> Column:
    """Null over constant vectors, where the built-in one raises."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def t_statistic(r: Column, n: Column) -> Column:
    return F.when(F.abs(r) >= 1, F.signum(r) * F.lit(float("inf"))).otherwise(r * F.sqrt((n - 2) / (1 - r * r)))


def spearman(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, n, rho): Spearman correlation of columns a and b within each key."""
    ranked = pairs.select(key, average_rank(a, key).alias("_a"), average_rank(b, key).alias("_b"))
    return ranked.groupBy(key).agg(F.count(F.lit(1)).alias("n"), pearson("_a", "_b").alias("rho"))


def with_rho(vectors: DataFrame, a: str, b: str) -> DataFrame:
    """Adds n and rho: the Spearman correlation of two arrays of a row, null over constant ones. Nothing is shuffled or sorted for it."""

    @F.pandas_udf("double")
    def rho(left: pd.Series, right: pd.Series) -> pd.Series:
        size = np.array([len(v) for v in left], np.int64)
        key = np.repeat(np.arange(len(size)), size)
        x, y = (_centred(np.concatenate([np.zeros(0), *side]), key, size) for side in (left, right))
        total = lambda v: np.bincount(key, v, len(size))
        down = np.sqrt(total(x * x) * total(y * y))
        return pd.Series(np.divide(total(x * y), down, out=np.full(len(size), np.nan), where=down > 0)).astype(object).where(down > 0, None)

    return vectors.withColumn("n", F.size(a).cast("long")).withColumn("rho", rho(a, b))


def _centred(v: np.ndarray, key: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ranks within runs of one key, ties sharing the mean of their places, less their mean."""
    order = np.lexsort((v, key))
    new = np.ones(len(v), bool)
    k, w = key[order], v[order]
    new[1:] = (k[1:] != k[:-1]) | ((w[1:] != w[:-1]) & ~(np.isnan(w[1:]) & np.isnan(w[:-1])))
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(v))
    out = np.empty(len(v))
    out[order] = np.repeat((starts + ends + 1) / 2, ends - starts)
    return out - np.repeat(size.cumsum() - size + (size + 1) / 2, size)


def centred_ranks(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the rank of ``value`` over all rows, ties sharing the mean of their places, less the mean rank."""
    numbered = row_number(rows, [F.col(value).asc()], "_i")
    at = numbered.groupBy(F.col(value).alias("_v")).agg(F.avg("_i").alias("_rank"))
    middle = (numbered.count() + 1) / 2
    return numbered.join(at, F.col(value) == F.col("_v")).withColumn(name, F.col("_rank") - middle).drop("_i", "_v", "_rank")


def correlate_with_column(ft: DataFrame, meta: DataFrame, column: str, value: str = "n") -> DataFrame:
    """Spearman correlation of every varying unit with a numeric metadata column, t-test p and BH adjustment.

    Samples need a value in the column and a place in the table; absent cells count as zeros but are never made: their
    common rank follows from how many cells of the unit are below zero and how many there are, and sums over them from
    sums over the cells that exist. Units without a correlation are left out.
    """
    known = meta.where(F.col(column).isNotNull()).select(SAMPLE, F.col(column).cast("double").alias("_m")).join(ft.select(SAMPLE).distinct(), SAMPLE, "left_semi")
    places = centred_ranks(known, "_m", "_y").select(SAMPLE, "_y")
    n, syy = places.agg(F.count(F.lit(1)), F.sum(F.col("_y") * F.col("_y"))).first()
    cells = ft.where(F.col(value) != 0).join(places, SAMPLE).select(TU, F.col(value).alias("_v"), "_y")
    cells = cells.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(TU))).withColumn("_r", average_rank("_v", TU))
    middle, zeros = (n + 1) / 2, n - F.col("_k")
    cells = cells.withColumn("_x", F.col("_r") + F.when(F.col("_v") > 0, zeros).otherwise(0) - middle)
    x, y = F.col("_x"), F.col("_y")
    sums = cells.groupBy(TU).agg(F.first("_k").alias("_k"), F.count_if(F.col("_v") < 0).alias("_low"), F.sum(x * y).alias("_xy"), F.sum(x * x).alias("_xx"), F.sum(y).alias("_sy"), F.sum("_v").alias("_sum"))
    zero = F.col("_low") + (zeros + 1) / 2 - middle
    sums = sums.withColumn("_xy", F.col("_xy") - zero * F.col("_sy")).withColumn("_xx", F.col("_xx") + zeros * zero * zero)
    rho = F.try_divide(F.col("_xy"), F.sqrt(F.col("_xx") * F.lit(syy or 0.0)))
    out = sums.select(TU, F.lit(n).cast("long").alias("n"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho)).alias("rho"), (F.col("_sum") / n).alias("average"), rho.isNotNull().alias("_any")).where("_any").drop("_any")
    out = out.withColumn("t", t_statistic(F.col("rho"), F.col("n"))).withColumn("p", t_pvalue("t", F.col("n") - 2))
    return adjust_bh(out, "p", "p_adj").select(TU, "n", "rho", "t", "p", "p_adj", "average")


def group_means(ft: DataFrame, meta: DataFrame, treatment: str | None, group: str, value: str = "n", pseudocount: float = 1.0) -> DataFrame:
    """(tu_id, treatment, group, mean): each unit's mean share in each group (of each treatment) after a constant is added
    to every cell, absent ones too; samples without group are left out.

    What the constant alone gives is the same for all units of a group, so a mean is that plus the shares of the cells that exist.
    """
    by = [*([treatment] if treatment else []), group]
    units = ft.select(TU).distinct()
    totals = ft.groupBy(SAMPLE).agg(F.sum(value).alias("_total")).withColumn("_total", F.col("_total") + units.count() * pseudocount)
    samples = totals.join(meta.where(F.col(group).isNotNull()), SAMPLE)
    part = lambda x: F.when(F.col("_total") != 0, x / F.col("_total")).otherwise(0.0)
    bases = samples.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.sum(part(F.lit(pseudocount))).alias("_base"))
    own = ft.join(samples, SAMPLE).groupBy(TU, *by).agg(F.sum(part(F.col(value))).alias("_own"))
    every = units.crossJoin(bases)  # the result's rows: each unit in each group
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [TU, *by]]
    both = every.alias("e").join(own.alias("o"), same, "left")
    return both.select(*[f"e.{c}" for c in [TU, *by]], ((F.col("_base") + F.coalesce("_own", F.lit(0.0))) / F.col("_n")).alias("mean"))


#: Pairs of blocks that a task gets, about.
PAIRS_OF_TASK = 32


def _unit_vectors(x: np.ndarray) -> np.ndarray:
    x = x - x.mean(1, keepdims=True)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), float).reshape(len(vectors), -1)


def block_pairs(packed: DataFrame, high: float, low: float, block: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """Units with their block, and the pairs of blocks (_x, _y) that can hold a correlation of ``high`` or more, or ``low`` or less.

    A correlation is the cosine of an angle, and the angles of two units to a third, a pivot, differ by no more than the angle
    between them. Units are dealt to blocks in order of their angles to the first pivot; a pair of blocks goes where the ranges of
    angles to any pivot are further apart than the threshold allows, both for the units and for one of them turned round.
    """
    some = [r["v"] for r in packed.orderBy("_i").limit(pivots).collect()]  # a few vectors
    turn = _unit_vectors(np.array(some, float)) if some else np.zeros((0, 0))

    @F.pandas_udf("array<double>")
    def angles(v: pd.Series) -> pd.Series:
        x = _unit_vectors(_matrix(v))
        found = np.arccos(np.clip(x @ turn.T, -1, 1))
        return pd.Series(list(np.where((x != 0).any(1)[:, None] & (turn != 0).any(1)[None, :], found, -1.0)))

    placed = row_number(packed.withColumn("_angles", angles("v")), [F.expr("_angles[0]").asc(), F.col("_i").asc()], "_n")
    placed = materialize(placed.withColumn("_block", F.expr(f"cast((_n - 1) div {block} as int)")), "ranked-units")
    # A unit without direction (constant), here -1, may be at any angle.
    least = [F.min(F.greatest(F.col("_angles")[p], F.lit(0.0))).alias(f"_l{p}") for p in range(len(some))]
    most = [F.max(F.when(F.col("_angles")[p] < 0, F.lit(float(np.pi))).otherwise(F.col("_angles")[p])).alias(f"_h{p}") for p in range(len(some))]
    ranges = placed.groupBy("_block").agg(*least, *most)
    one, two = (ranges.select(*[F.col(c).alias(f"{c}{side}") for c in ranges.columns]) for side in "xy")
    both = one.join(two, F.col("_blockx") <= F.col("_blocky"))  # a row for each pair of blocks, units apart by the square of ``block``
    apart = lambda l1, h1, l2, h2: F.greatest(l1 - h2, l2 - h1)
    same, turned = F.lit(True), F.lit(True)
    for p in range(len(some)):
        l1, h1, l2, h2 = (F.col(f"{c}{p}{side}") for side in "xy" for c in ("_l", "_h"))
        same = same & (apart(l1, h1, l2, h2) <= float(np.arccos(np.clip(high, -1, 1))) + 1e-6)
        turned = turned & (apart(l1, h1, float(np.pi) - h2, float(np.pi) - l2) <= float(np.arccos(np.clip(-low, -1, 1))) + 1e-6)
    return placed, both.where(same | turned).select(F.col("_blockx").alias("_x"), F.col("_blocky").alias("_y"))


def correlate_units(vectors: DataFrame, key: str, at: str, value: str, *, high: float = 0.0, low: float = 0.0, most_p: float = 1.0, block: int = 512, least: int = 3, pivots: int = 4, digits: int | None = None) -> DataFrame:
    """(a, b, n, rho, p) for pairs of units a before b: Spearman with normal p, within thresholds; rho is rounded to ``digits`` afterwards.

    ``vectors`` is long and complete: (key, at, value) for each unit and place. Units of equal ranks are a class, and classes are
    correlated once: they are packed into blocks of ranked vectors; each pair of blocks that can hold what is wanted (see ``block_pairs``) is one
    matrix product, and thresholds apply inside, so no pair is emitted in vain. A pair of classes then gives the pairs of its units, from
    parts of half a block of units each, by as many tasks as there are pairs. Constant units correlate 0 with everything.
    """
    ranked = vectors.where(F.col(key).isNotNull()).select(key, at, average_rank(value, key).alias("_r"))
    packed = ranked.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(at, "_r"))), lambda x: x["_r"]).alias("v"))
    units = row_number(materialize(packed, "packed-units"), [F.col("v").asc(), F.col(key).asc()], "_n")  # a class has numbers without gaps
    part = max(1, block // 2)
    classes = materialize(units.groupBy("v").agg(F.min("_n").alias("_i"), F.count(F.lit(1)).alias("_size")), "classes")
    parts = units.groupBy("v", F.expr(f"(_n - 1) div {part}").alias("_p")).agg(F.collect_list(key).alias("_names"))
    parts = materialize(parts.join(classes, "v").select("_i", "_p", "_names"), "parts-of-classes")
    placed, wanted = block_pairs(classes, high, low, block, pivots)
    wanted = materialize(wanted, "block-pairs")
    few = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = wanted.select("_x", "_y", F.explode(F.array_distinct(F.array("_x", "_y"))).alias("_block"))
    pairs = placed.join(sides, "_block")

    def correlate(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = int(pdf["_x"].iloc[0]), int(pdf["_y"].iloc[0])
        left, right = pdf[pdf["_block"] == x].sort_values("_i"), pdf[pdf["_block"] == y].sort_values("_i")
        a, b = (_unit_vectors(_matrix(p["v"])) for p in (left, right))
        r = np.clip(a @ b.T, -1, 1) if len(a) and len(b) else np.zeros((len(a), len(b)))
        one, two, of_one, of_two = (p[c].to_numpy() for c in ("_i", "_size") for p in (left, right))
        before, after = one[:, None], two[None, :]
        i, j = np.nonzero(((r >= high) | (r <= low)) & ((before < after) | ((before > after) & (x != y)) | ((before == after) & (of_one[:, None] > 1))))
        n = a.shape[1] if len(a) else 0
        return pd.DataFrame({"_a": one[i], "_b": two[j], "_of_a": of_one[i], "_of_b": of_two[j], "n": n, "rho": r[i, j]})

    pairs = pairs.repartition(max(few, -(-wanted.count() // PAIRS_OF_TASK)), "_x", "_y")  # pairs of blocks grow with the square of the classes, those of a task don't
    found = pairs.groupBy("_x", "_y").applyInPandas(correlate, "_a long, _b long, _of_a long, _of_b long, n long, rho double").where(F.col("n") >= least)
    found = found.withColumn("p", norm_pvalue(t_statistic(F.col("rho"), F.col("n")))).where(F.col("p") <= most_p)
    found = materialize(found if digits is None else found.withColumn("rho", F.round("rho", digits)), "class-pairs")
    rows = found.agg(F.sum(F.col("_of_a").cast("double") * F.col("_of_b"))).first()[0] or 0
    tasks = max(few, int(-(-rows // (PAIRS_OF_TASK * part * part))))
    spots = lambda c: (F.expr(f"(_{c} - 1) div {part}"), F.expr(f"(_{c} + _of_{c} - 2) div {part}"))
    both = found.withColumn("_pa", F.explode(F.sequence(*spots("a"))))
    both = both.withColumn("_pb", F.explode(F.sequence(F.when(F.col("_a") == F.col("_b"), F.col("_pa")).otherwise(spots("b")[0]), spots("b")[1])))
    both = both.select("_a", "_pa", "_b", "_pb", "n", "rho", "p").repartition(tasks, "_a", "_pa", "_b", "_pb")
    for c in "ab":  # the units' names, few beside their pairs
        both = both.join(F.broadcast(parts.select(F.col("_i").alias(f"_{c}"), F.col("_p").alias(f"_p{c}"), F.col("_names").alias(f"_names_{c}"))), [f"_{c}", f"_p{c}"])
    same = (F.col("_a") == F.col("_b")) & (F.col("_pa") == F.col("_pb"))
    both = both.select("n", "rho", "p", "_names_b", same.alias("_same"), F.explode("_names_a").alias("_one"))
    both = both.select("n", "rho", "p", "_same", "_one", F.explode("_names_b").alias("_two")).where("not _same or _one < _two")
    return both.select(F.least("_one", "_two").alias("a"), F.greatest("_one", "_two").alias("b"), "n", "rho", "p")


def abundant_in_sets(ft: DataFrame, sets: DataFrame, least: float, value: str = "n") -> DataFrame:
    """(set, tu_id, mean) of units whose mean over a set's samples, absent cells as zeros, is ``least`` or more.

    ``sets`` lists samples (sample_id, set); each set is filtered by its own means.
    """
    sets = sets.select(SAMPLE, "set").distinct()
    sizes = sets.groupBy("set").agg(F.count(F.lit(1)).alias("_n"))
    sums = ft.join(sets, SAMPLE).groupBy("set", TU).agg(F.sum(value).alias("_sum"))
    return sums.join(sizes, "set").select("set", TU, (F.col("_sum") / F.col("_n")).alias("mean")).where(F.col("mean") >= least)


def fold_changes(means: DataFrame, treatment: str, group: str, before: str, after: str) -> DataFrame:
    """(tu_id, group, before, after, change): mean after over mean before, where a group has both."""
    one = means.where(F.col(treatment) == before).select(TU, group, F.col("mean").alias("before"))
    two = means.where(F.col(treatment) == after).select(TU, group, F.col("mean").alias("after"))
    return one.join(two, [TU, group]).withColumn("change", F.try_divide("after", "before"))


def correlate_with_change(means: DataFrame, treatment: str, group: str, set_a: str, before: str, after: str) -> DataFrame:
    """Per unit, Spearman over groups of its abundance under ``set_a`` with its fold change; units without one are kept."""
    of = lambda x: F.when(F.col(treatment) == x, F.col("mean"))
    some = means.where(F.col(treatment).isin(set_a, before, after) & F.col(TU).isNotNull() & F.col(group).isNotNull())
    each = some.groupBy(TU, group).agg(F.max(of(set_a)).alias("abundance"), F.max(of(before)).alias("_before"), F.max(of(after)).alias("_after"))
    both = each.select(TU, group, "abundance", F.try_divide("_after", "_before").alias("change")).where("abundance is not null and change is not null")
    vectors = both.groupBy(TU).agg(F.sort_array(F.collect_list(F.struct(group, "abundance", "change"))).alias("v"))
    vectors = vectors.select(TU, *[F.col(f"v.{c}").alias(n) for c, n in ((group, "groups"), ("abundance", "abundances"), ("change", "changes"))])
    out = with_rho(vectors, "abundances", "changes")
    out = materialize(out.withColumn("p", t_pvalue(t_statistic(F.col("rho"), F.col("n")), F.col("n") - 2)), "change-correlations")  # read three times by the adjustment
    return adjust_bh(out, "p", "p_adj").select(TU, "n", "rho", "p", "p_adj", "groups", "abundances", "changes")


def correlate_with_external(prior: DataFrame, external: DataFrame, groups: str = "groups", values: str = "changes") -> DataFrame:
    """Per unit, Spearman of a stored vector with external values (name, value) of the same groups.

    Units whose vectors differ in length are skipped; groups without external value are left out; fewer than two
    groups give no correlation.
    """
    listed = external.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))).select("name", F.col("value").cast("double").alias("_value"))
    same = prior.where(F.size(groups) == F.size(values)).select(TU, F.explode(F.arrays_zip(F.col(groups).alias("g"), F.col(values).alias("v"))).alias("x"))
    both = same.select(TU, F.col("x.g").alias("name"), F.col("x.v").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")).join(listed, "name")
    vectors = both.groupBy(TU).agg(F.collect_list(F.struct("v", "_value")).alias("x")).select(TU, F.col("x.v").alias("_a"), F.col("x._value").alias("_b"))
    rho = with_rho(vectors, "_a", "_b").select(TU, "n", F.when(F.col("n") >= 2, F.col("rho")).alias("rho"))
    rho = materialize(rho.withColumn("p", t_pvalue(t_statistic(F.col("rho"), F.col("n")), F.col("n") - 2)), "external-correlations")
    return adjust_bh(rho, "p", "p_adj")
