"""Exact top-k inner-product search: a ball tree for each shard, branch and bound, and the kth score shared in rounds."""

from __future__ import annotations

import math
import pickle
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, tidy

LEAF = 64
#: The largest and the least score that a long column holds (the least one stands for scores below it).
MOST, LEAST = 2**63 - 1, -(2**63)


def scaled(vectors, scale: float) -> np.ndarray:
    """floor(scale * x) of each component, exact: the narrowest NumPy integers that hold them all, else Python's."""
    x = np.array(vectors, float).reshape(len(vectors), -1)
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    top = np.abs(y).max(initial=0)
    if top < 2**62:
        return y.astype(np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.int64)
    whole = [[math.floor(Fraction(scale) * Fraction(c)) for c in row] for row in x.tolist()]
    return np.array(whole, object).reshape(x.shape)


def exact_type(x: np.ndarray, y: np.ndarray):
    """A type in which inner products of rows of both are exact: floats (fast), longs or Python integers."""
    top = int(abs(x).max(initial=0)) * int(abs(y).max(initial=0)) * x.shape[1] if x.size and y.size else 0
    return float if top < 2**53 else np.int64 if top < 2**62 else object


def floored(score: np.ndarray) -> np.ndarray:
    """Floats that aren't above the scores."""
    f = score.astype(float)
    return np.where(np.abs(f) < 2**53, f, np.nextafter(f, -np.inf))


class BallTree:
    """Vectors in leaf order; nodes with centre, radius, slice of the vectors and children (-1: leaf)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order, nodes, todo = np.arange(len(x)), [], [(0, len(x), -1, 0)]
        flat = x.dtype == object  # no floats hold them: nodes without geometry, whose bounds are infinite
        f = np.zeros(x.shape) if flat else x.astype(float)
        while todo:
            a, b, parent, side = todo.pop()
            rows = f[order[a:b]]
            centre = rows.mean(0)
            far = rows - centre
            dist = np.sqrt((far * far).sum(1))
            me = len(nodes)
            nodes.append([centre, np.inf if flat else dist.max(), a, b, -1, -1])
            if parent >= 0:
                nodes[parent][4 + side] = me
            if b - a > LEAF and (flat or dist.max() > 0):
                if not flat:
                    one = rows[dist.argmax()]
                    other = rows[((rows - one) ** 2).sum(1).argmax()]
                    by = np.argsort(rows @ (other - one), kind="stable")
                    order[a:b] = order[a:b][by]
                mid = (a + b) // 2
                todo += [(a, mid, me, 0), (mid, b, me, 1)]
            else:
                order[a:b] = order[a:b][np.argsort(ids[order[a:b]], kind="stable")]
        self.ids, self.x = ids[order], x[order]
        self.centre = np.array([n[0] for n in nodes]).reshape(len(nodes), -1)
        self.radius = np.array([n[1] for n in nodes])
        self.span = np.array([n[2:4] for n in nodes])
        self.child = np.array([n[4:6] for n in nodes])

    def upper(self, q: np.ndarray, norm: np.ndarray, query: np.ndarray, node: np.ndarray) -> np.ndarray:
        """No inner product of query and a vector in the node is above this."""
        with np.errstate(invalid="ignore", over="ignore"):
            dot = np.einsum("ij,ij->i", q[query], self.centre[node])
            away = norm[query] * self.radius[node]
            bound = dot + away + 1e-9 * (norm[query] * np.sqrt((self.centre[node] ** 2).sum(1)) + away) + 1e-6
        return np.where(np.isnan(bound), np.inf, bound)

    def search(self, qid: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int, leaves: int | None = None):
        """(query index, ids, scores): each query's k best here that score at least ``kth``, ties to smaller ids.

        Nodes whose bound is under the current kth score are dropped; leaves are read in order of their bounds, and the
        kth score rises meanwhile. ``leaves`` stops after so many leaves of a query (for a first bound).
        """
        exact, n = exact_type(self.x, q), len(q)
        x, y = self.x.astype(exact), q.astype(exact)
        with np.errstate(over="ignore", invalid="ignore"):
            f = np.array([[min(max(c, -(10**300)), 10**300) for c in row] for row in q.tolist()], float) if q.dtype == object else q.astype(float)
            norm = np.where(np.isfinite(size := np.sqrt((f * f).sum(1))), size, np.inf)
        low = LEAST
        best, best_ids = np.full((n, k), low), np.full((n, k), np.iinfo(np.int64).max)
        kth = kth.copy()
        query, node, ends = np.arange(n), np.zeros(n, np.int64), []
        while len(query):
            bound = self.upper(f, norm, query, node)
            live = bound >= kth[query]
            query, node, bound = query[live], node[live], bound[live]
            at_end = self.child[node, 0] < 0
            ends.append((query[at_end], node[at_end], bound[at_end]))
            query, node = query[~at_end], node[~at_end]
            if leaves is not None and len(query):  # only the better child of each node is entered
                two = [self.upper(f, norm, query, self.child[node, s]) for s in (0, 1)]
                node = self.child[node, (two[1] > two[0]).astype(int)]
            else:
                query, node = np.repeat(query, 2), self.child[node].ravel()
        query, node, bound = (np.concatenate(c) for c in zip(*ends))
        by = np.lexsort((-bound, query))
        query, node, bound = query[by], node[by], bound[by]
        first = np.searchsorted(query, np.arange(n))
        turn = np.arange(len(query)) - first[query]
        for t in range(int(turn.max(initial=-1)) + 1):
            now = np.flatnonzero(turn == t)
            now = now[bound[now] >= kth[query[now]]]
            now = now[np.argsort(node[now], kind="stable")]
            for part in np.split(now, np.flatnonzero(np.diff(node[now])) + 1) if len(now) else []:
                who, (a, b) = query[part], self.span[node[part[0]]]
                score = y[who] @ x[a:b].T
                if exact is object:
                    if any(c > MOST for c in score.ravel() if c is not None):
                        own = qid[who][:, None] == self.ids[a:b][None, :]
                        if any(c > MOST for c in score[~own]):
                            raise OverflowError("a score doesn't fit a long")
                        score[own] = low
                    score = np.maximum(score, LEAST + 1)
                score = score.astype(np.int64)
                own = qid[who][:, None] == self.ids[a:b][None, :]
                score[own] = low
                all_s = np.concatenate([best[who], score], 1)
                all_i = np.concatenate([best_ids[who], np.broadcast_to(self.ids[a:b], score.shape)], 1)
                pick = np.lexsort((all_i, -all_s.astype(float) if exact is float else ~all_s), axis=1)[:, :k]
                best[who] = np.take_along_axis(all_s, pick, 1)
                best_ids[who] = np.take_along_axis(all_i, pick, 1)
                kth[who] = np.maximum(kth[who], floored(best[who, k - 1]))
        ok = (best > low) & (best.astype(float) >= kth[:, None])
        return np.nonzero(ok)[0], best_ids[ok], best[ok]


def whole_vectors(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, v, wide): vectors as doubles, without nulls and non-finite components; rows without id or vector go. Wide ones
    have a component of 2^31 or more when scaled; they get shards of their own, so that others keep narrow integers."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("v"))
    return rows.where(F.coalesce(fine, F.lit(False))).withColumn("wide", F.exists("v", lambda c: F.abs(c) >= 2.0**31 / scale))


def top_k(
    df: DataFrame, *, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding", scale: float = 1024.0,
    shard_rows: int = 8192, block_rows: int = 1024,
) -> DataFrame:
    """Each query's k best vectors by integer inner product: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those with the query's id.
    Rows are hashed to shards of about ``shard_rows`` and each shard gets a ball tree; queries travel in blocks of about
    ``block_rows``, and each pair of shard and block is a task of its own. A first round reads the most promising leaf
    of every shard; the kth best of what all shards found bounds each query's second round, the exact search.

    Vectors that are null or hold nulls or non-finite components take no part, nor do rows without id; vectors are
    compared with those of their own length. All finite ones are scored exactly, in floats, longs or Python integers as
    their size asks; a score among the best that no long holds is an error, never another number. Rows that repeat an id
    are candidates each (for queries of other ids), and the least vector of an id is its query. Ties go to the smaller
    vec_id. Fewer than k candidates give fewer rows, an empty table none; extra columns are ignored.
    """
    rows = materialize(whole_vectors(tidy(df, [key, vector]), key, vector, scale), "vectors").withColumn("dim", F.size("v"))
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-n // (every * block_rows)))

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = BallTree(pdf["id"].to_numpy(np.int64), scaled(pdf["v"].tolist(), scale))
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "wide": pdf["wide"].iloc[:1], "shard": pdf["shard"].iloc[:1], "tree": [pickle.dumps(tree, 5)]})

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    trees = materialize(sharded.groupBy("dim", "wide", "shard").applyInPandas(plant, "dim int, wide boolean, shard int, tree binary"), "ball-trees")
    trees = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("v", "wide")).alias("r")).select("id", "r.*").withColumn("dim", F.size("v"))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def search(queries: DataFrame, leaves: int | None) -> DataFrame:
        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            q = scaled(pdf["v"].tolist(), scale)
            kth = pdf["kth"].to_numpy(float)
            return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "block": pdf["block"].iloc[:1], "queries": [pickle.dumps((pdf["id"].to_numpy(np.int64), q, kth), 5)]})

        def run(batches):
            for b in batches:
                for tree, packed in zip(b["tree"], b["queries"]):
                    qid, q, kth = pickle.loads(packed)
                    who, ids, scores = pickle.loads(tree).search(qid, q, kth, k, leaves)
                    yield pd.DataFrame({"query_id": qid[who], "vec_id": ids, "score": scores})

        packed = queries.groupBy("dim", "wide", "block").applyInPandas(pack, "dim int, block int, queries binary")
        packed = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        pairs = trees.join(packed, ["dim", "shard", "block"]).select("tree", "queries")
        return pairs.mapInPandas(run, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    low = F.lit(float("-inf"))
    score = F.col("score").cast("double")
    lower = F.when(F.abs(score) < 2.0**53, score).otherwise(score - F.abs(score) * 2.0**-52)  # not above the score
    first = search(queries.withColumn("kth", low), 1).withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    bounds = first.select(F.col("query_id").alias("id"), lower.alias("kth"))
    bounded = materialize(queries.join(bounds, "id", "left").withColumn("kth", F.coalesce("kth", low)), "bounded-queries")
    found = search(bounded, None).withColumn("rank", F.row_number().over(best))
    fits = F.when(F.col("score") > LEAST + 1, F.col("score")).otherwise(F.raise_error(F.lit("a score doesn't fit a long")).cast("long"))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", fits.alias("score"))


def sql(k: int = 10, every: int = 100, scale: int = 1024) -> str:
    """DuckDB SQL for ``top_k`` over table ``embeddings``, by comparing each query with all rows."""
    return f"""
WITH v AS (
  SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
