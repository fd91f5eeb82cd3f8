"""Local search against full dynamic programming in plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.operators import hits, search

RANDOM = random.Random(11)


def dna(n, rng=RANDOM):
    return "".join(rng.choice("ACGT") for _ in range(n))


def changed(s, rng, n):
    s = list(s)
    for _ in range(n):
        i = rng.randrange(len(s))
        s[i : i + 1] = rng.choice([[rng.choice("ACGT")], [], [s[i], rng.choice("ACGT")]])
    return "".join(s)


def best_score(q, s, c):
    """The highest local score with affine gaps, over the whole table."""
    none = -(10**9)
    h, e, best = [0] * (len(s) + 1), [none] * (len(s) + 1), 0
    for x in q:
        last, f, h[0] = h[0], none, 0
        for j, y in enumerate(s, 1):
            e[j] = max(h[j] - c.gap_open, e[j]) - c.gap_extend
            f = max(h[j - 1] - c.gap_open, f) - c.gap_extend
            last, h[j] = h[j], max(0, last + (c.match if x == y else c.mismatch), e[j], f)
            best = max(best, h[j])
    return best


def other_strand(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def fixture():
    rng = random.Random(4)
    base = [dna(90, rng) for _ in range(4)]
    subjects = [(f"s{i}", dna(rng.randint(0, 60), rng) + changed(rng.choice(base), rng, i % 9) + dna(rng.randint(0, 80), rng)) for i in range(24)]
    subjects += [("rev", dna(30, rng) + other_strand(base[0]) + dna(9, rng)), ("none", dna(200, rng)), ("empty", ""), ("short", "ACG")]
    queries = [(f"q{i}", changed(b, rng, 2)) for i, b in enumerate(base)] + [("qe", ""), ("qs", "ACGT"), ("part", base[1][30:60])]
    return queries, subjects


@pytest.mark.parametrize("scoring,window,frequent", [(search.SENSITIVE, None, 4096), (search.SENSITIVE, 4, 3), (search.CLOSE, None, 2)])
def test_hits_equal_full_dynamic_programming(spark, scoring, window, frequent):
    queries, subjects = fixture()
    q, s = spark.createDataFrame(queries, "qseqid string, seq string"), spark.createDataFrame(subjects, "sseqid string, seq string").withColumn("stitle", F.concat(F.lit("title "), "sseqid"))
    got = {(r.qseqid, r.sseqid): r for r in search.local_search(q, s, scoring, evalue=1e9, window=window, frequent=frequent).collect()}
    for a, x in queries:
        for b, y in subjects:
            word = any(t[i : i + scoring.word] in y for t in (x, other_strand(x)) for i in range(len(t) - scoring.word + 1))
            if word:
                r = got.pop((a, b))
                assert r.score == max(best_score(t, y, scoring) for t in (x, other_strand(x))) and r.stitle == f"title {b}"
                assert r.length >= r.mismatch and 0 < r.pident <= 100 and 0 < r.qcovs <= 100
    # Words that only shorter sequences than a window share give more hits, never other scores.
    assert all(r.score == max(best_score(t, dict(subjects)[b], scoring) for t in (dict(queries)[a], other_strand(dict(queries)[a]))) for (a, b), r in got.items())


def test_columns_ranks_and_thresholds(spark):
    seq = dna(60)
    q = spark.createDataFrame([("q", seq), ("n", None)], "qseqid string, seq string")
    s = spark.createDataFrame([("a", "TT" + seq[:30] + ("A" if seq[30] != "A" else "C") + seq[31:]), ("b", seq), ("c", seq), ("d", seq[:20]), (None, None)], "sseqid string, seq string").withColumn("staxids", F.array(F.col("sseqid")))
    got = search.local_search(q, s, max_targets=3, both_strands=False).orderBy("hit_ord").collect()
    assert [(r.sseqid, r.hit_ord, r.score) for r in got[:2]] == [("b", 1, 120), ("c", 2, 120)] and len(got) == 3
    assert (got[2].sseqid, got[2].mismatch, got[2].length, got[2].staxids) == ("a", 1, 60, ["a"]) and got[0].pident == 100 and got[0].qcovs == 100
    assert got[0].evalue < 1e-10 and search.local_search(q, s, evalue=1e-60).count() == 0
    assert search.local_search(q.where("false"), s).count() == 0 and search.local_search(q, s.where("false")).count() == 0


def test_minimisers_of_equal_stretches_meet():
    rng = random.Random(6)
    for k, window in ((5, 1), (4, 6), (8, 9)):
        for _ in range(50):
            common = dna(k + window - 1, rng)
            a, b = (dna(rng.randint(0, 30), rng) + common + dna(rng.randint(0, 30), rng) for _ in range(2))
            (ha, pa_), (hb, pb) = (search.minimisers(x.encode(), k, window) for x in (a, b))
            i, j = a.index(common), b.index(common)
            mine = {(h, p - i) for h, p in zip(ha.tolist(), pa_.tolist())}
            assert mine & {(h, p - j) for h, p in zip(hb.tolist(), pb.tolist())}
    assert len(search.minimisers(b"AC", 3, 1)[0]) == 0 and np.array_equal(search.minimisers(b"ACGTA", 3, 9)[1].shape, (1,))


def test_search_feeds_deepening(spark):
    queries, subjects = fixture()
    q, s = spark.createDataFrame(queries, "qseqid string, seq string"), spark.createDataFrame(subjects, "sseqid string, seq string")
    table = q.withColumn("size", F.lit(10).cast("long"))
    first = search.local_search(q, s, max_targets=1)
    every, need = hits.deepen(first, table, search.searcher(q, s, [1, 50]), rounds=1)
    alike = {r.qseqid for r in hits.needs_deeper(first, table).collect()}
    counts = {r.qseqid: r.n for r in every.groupBy("qseqid").agg(F.countDistinct("sseqid").alias("n")).collect()}
    assert alike and all(counts[a] > 1 for a in alike if a != "qs") and need.columns
