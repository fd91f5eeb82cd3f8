import hashlib
import math

import pytest
from pyspark.sql import functions as F

from taxaflow.llm import code_lloyd, queries
from tests.llm.helpers import duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, code, error, label_error, sha) by Lloyd's rounds in Python integers, all sums anew in each round."""
    kept = sorted(((i, [math.floor(scale * c) for c in v], n) for i, v, n in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    w = -(-size // parts)
    cut = [[(v + [0] * (parts * w - size))[p * w : p * w + w] for p in range(parts)] for _, v, _ in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, p: min((far(x[p], e), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        where = [[near(x, p)[1] for p in range(parts)] for x in cut]
        for p in range(parts):
            for i in range(len(books[p])):
                if own := [x[p] for x, a in zip(cut, where) if a[p] == i]:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    found = [[near(x, p) for p in range(parts)] for x in cut]
    error = [sum(d for d, _ in f) for f in found]
    label = lambda n: sum(e for e, r in zip(error, kept) if r[2] == n)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in f), e, label(r[2]), sha) for r, f, e in zip(kept, found, error)), key=repr)


def coded(df, **options):
    out, books = code_lloyd.compress(df, keep=("label",), **options)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, books.sha256()) for r in code_lloyd.with_group_errors(out).collect()), key=repr)


def test_query(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = queries.op12_codes(spark, SF)
    assert sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in got.collect()), key=repr) == plain(rows)
    assert duck_rows(code_lloyd.sql(), tmp_path, embeddings=df) == spark_rows(got)


ODD = [
    (3, [0.5, -0.25, 1.0], 1), (3, [0.5, -0.25, 1.0], 1), (3, [0.25, 0.0, 0.0], None), (None, [0.1, 0.2, 0.3], None), (-5, [9.0, -9.0, 0.0], 2), (7, None, 1), (8, [0.1, None, 0.2], 1),
    (9, [float("nan"), 0.0, 0.0], 1), (10, [float("inf"), 0.0, 0.0], 1), (11, [1.0, 2.0], 1), (12, [], 1), (13, [1e5, -1e5, 3e5], 2), (14, [1e5, -1e5, 2e5], 2), (15, [1e-9, -1e-9, 0.0], 2),
]


@pytest.mark.parametrize("parts,entries,rounds", [(2, 3, 4), (3, 16, 6), (8, 1, 0), (1, 2, 1)])
def test_odd_rows(spark, parts, entries, rounds):
    df = spark.createDataFrame(ODD, VEC).select("*", F.lit("x").alias("Label"), F.lit(1).alias("_key"), F.lit(2).alias("v"))
    assert coded(df, parts=parts, entries=entries, rounds=rounds) == plain(ODD, parts, entries, rounds)


def test_empty_one_and_too_large(spark):
    assert coded(spark.createDataFrame([], VEC)) == []
    assert coded(spark.createDataFrame([(1, [], None), (2, [], 4)], VEC)) == plain([(1, [], None), (2, [], 4)])
    with pytest.raises(Exception, match="too large"):
        coded(spark.createDataFrame([(1, [1e30], None)], VEC))
    with pytest.raises(ValueError):
        code_lloyd.compress(spark.createDataFrame([], VEC), entries=257)


def test_only_moved_parts_are_added(spark):
    """Well separated groups settle after a round: nothing moves any more, and the sums stay."""
    rows = [(i, [100.0 * (i % 4) + 0.001 * i, float(i % 3)], 0) for i in range(400)]
    seen = []
    add = code_lloyd.Sums.add
    try:
        code_lloyd.Sums.add = lambda self, rows: (seen.append(len(rows)), add(self, rows))[1]
        got = coded(spark.createDataFrame(rows, VEC), parts=2, entries=4)
    finally:
        code_lloyd.Sums.add = add
    assert got == plain(rows, 2, 4) and seen[0] > 0 and seen[-3:] == [0, 0, 0]


def test_decode(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(50)
    out, books = code_lloyd.compress(df, rounds=2)
    both = books.decode(out).join(df, "vec_id").collect()
    assert len(both) == 50
    for r in both:
        off = sum((math.floor(4096 * a) - (4096 * b - 0.5)) ** 2 for a, b in zip(r.embedding, r.vector))
        assert len(r.vector) == len(r.embedding) and off == pytest.approx(r.error, rel=1e-6)
