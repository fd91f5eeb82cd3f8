"""Near pairs of texts that have much in common, against all pairs."""

import random

from pyspark.sql import functions as F

from taxaflow.operators import near


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng, s, edits):
    for _ in range(edits):
        i = rng.randrange(len(s))
        s = rng.choice([s[:i] + s[i + 1 :], s[:i] + rng.choice("abc ") + s[i:], s[:i] + rng.choice("abc ") + s[i + 1 :]])
    return s


def pairs_of(spark, seqs, edits):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i long, seq string")
    v, u = rows.select(F.col("i").alias("v"), "seq"), rows.select(F.col("i").alias("u"), "seq", F.lit(edits).alias("e"))
    windows, parts = near.shared_keys(v, u)
    met = windows.join(parts, "key").where("u < v").select("u", "v").distinct().count()
    found = {(r.u, r.v): r.edits for r in near.near_pairs(v, u, earlier=True, keys=(windows, parts)).collect()}
    return met, found


def test_same_beginnings_are_not_compared_in_pairs(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz ,."
    some = lambda n: "".join(rng.choices(letters, k=n))
    start, end = some(60), some(60)
    seqs = [start + some(40) for _ in range(120)] + [some(40) + end for _ in range(120)] + [some(30) + start[:50] + some(20) for _ in range(120)]
    seqs += [changed(rng, s, rng.randrange(5)) for s in rng.sample(seqs, 60)]
    met, found = pairs_of(spark, list(dict.fromkeys(seqs)), 3)
    seqs = list(dict.fromkeys(seqs))
    want = {(i, j): d for j in range(360, len(seqs)) for i in range(j) if abs(len(seqs[i]) - len(seqs[j])) <= 3 and (d := distance(seqs[i], seqs[j])) <= 3}
    assert {k: d for k, d in found.items() if k[1] >= 360} == want and len(want) >= 30
    assert met < 2000  # of 3 * 7,140 that share a part of the whole


def test_numbered_names_are_joined_by_what_differs(spark):
    names = [f"Customer#{i:09d}" for i in range(0, 3000, 7)] + ["Customer#00000014", "Customer#0000000014", "customer#000000014"]
    met, found = pairs_of(spark, names, 1)
    want = {(i, j): d for j in range(len(names)) for i in range(j) if (d := distance(names[i], names[j])) <= 1}
    assert found == want and want
    assert met < 10 * len(names)
