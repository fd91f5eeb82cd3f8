import numpy as np
import pytest

from taxaflow.llm import topk
from tests.llm.helpers import duck_rows, spark_rows


def plain(rows, k=10, every=100):
    ok = [(i, np.floor(1024 * np.array(v, float)).astype(object)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in ok:
        if q % every == 0:
            s = sorted((-int(sum(int(a) * int(b) for a, b in zip(x, y))), i) for i, y in ok if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -v) for r, (v, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 3000.0])
def test_exact(spark, tmp_path, spread):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 1, (6, 8))
    rows = [(i, [float(np.float32(x)) for x in np.round((base[i % 6] + rng.normal(0, 0.2, 8)) * spread, 2)]) for i in range(500)]
    rows += [(501 + i, rows[3][1]) for i in range(40)] + [(600, None), (700, [1.0, None] + [0.0] * 6), (800, [float("nan")] * 8), (900, [float("inf")] * 8), (None, rows[0][1]), (1000, [1.0, 2.0]), (1001, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, shard_rows=150, block_rows=2)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == plain(rows)
    assert spark_rows(got) == duck_rows(topk.sql(), tmp_path, embeddings=df)


def test_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(df.where("false")).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x = rng.integers(-2000, 2000, (700, 5))
    tree = topk.BallTree(np.arange(700), x)
    q = rng.integers(-2000, 2000, (20, 5)).astype(float)
    norm = np.sqrt((q * q).sum(1))
    for node, (a, b) in enumerate(tree.span):
        top = (q @ tree.x[a:b].T).max(1)
        assert (top <= tree.upper(q, norm, np.arange(20), np.full(20, node))).all()


def test_large_components_are_scored_exactly(spark):
    rng = np.random.default_rng(5)
    rows = [(0, [1.0, 0.0]), (1, [5e12, 3.0]), (2, [2.0, 1e9]), (3, [-5e12, 1.0]), (100, [0.0, 1e-3]), (4, [8.5e12, -1e9]), (5, [1e300, 0.5])]
    rows += [(200, [0.0, 7.0])] + [(10 + i, [float(x) for x in rng.normal(0, 10.0 ** rng.integers(0, 9), 2)]) for i in range(200) if (10 + i) % 100]
    some = [r for r in rows if r[0] != 5]
    df = spark.createDataFrame(some, "vec_id long, embedding array<double>")
    got = topk.top_k(df, shard_rows=40)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == plain(some)
    assert (0, 1, 4, 1024 * 1024 * 85 * 10**11) in {tuple(r) for r in got.collect()}
    with pytest.raises(Exception, match="fit a long"):  # 1e300 * 1 is above every long
        topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    with pytest.raises(Exception, match="fit a long"):  # below every long, and one of the ten best
        topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [-1e300])], "vec_id long, embedding array<double>")).collect()


def test_scaling_is_exact():
    assert topk.scaled([[1e300, -0.3], [0.0, 2.0**60]], 1024.0).tolist() == [[1024 * int(1e300), -308], [0, 2**70]]
    assert topk.scaled([[0.5, -0.5]], 1024.0).dtype == np.int16 and topk.scaled([[2.0**20, 0.1]], 1024.0).dtype == np.int32


def test_extra_columns_repeated_ids_and_nulls(spark):
    rows = [(0, [1.0], 1), (0, [3.0], 2), (1, [2.0], 3), (None, [9.0], 4), (2, [], 5), (100, [], 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = sorted(map(tuple, topk.top_k(df).collect()))
    assert got == [(0, 1, 1, 1024 * 2048), (100, 1, 2, 0)]
