"""The word classifier and the removal of reads that match references, against plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from taxaflow.operators import classify, reads


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def kmer_set(s, k):
    return {s[i : i + k] for i in range(len(s) - k + 1)} if s else set()


def references(rng):
    out = []
    for p in "AB":
        phylum = dna(rng, 60)
        for g in "xyz":
            genus = phylum[:30] + dna(rng, 40)
            out += [(genus[:i] + rng.choice("ACGT") + genus[i + 1 :], ["d__D", f"p__{p}", f"g__{p}{g}"]) for i in rng.sample(range(60), rng.randint(1, 4))]
    return out + [("ACG", ["d__D", "p__short"]), (None, ["d__D"]), (dna(rng, 40), None)]


def plain_scores(refs, k):
    refs = [(kmer_set(s, k), ";".join(x)) for s, x in refs if s and x and len(s) >= k]
    n = Counter(w for ws, _ in refs for w in ws)
    prior = {w: (c + 0.5) / (len(refs) + 1) for w, c in n.items()}
    have, size = defaultdict(Counter), Counter()
    for ws, t in refs:
        have[t].update(ws)
        size[t] += 1
    gain = lambda t, w: math.log((have[t][w] + prior[w]) / prior[w]) if have[t][w] else 0.0
    return lambda t, words: sum(gain(t, w) for w in words) - len(words) * math.log(size[t] + 1), lambda words: [t for t in have if any(have[t][w] for w in words)]


def chain(*values):
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else v.to_bytes(4, "little")
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


@pytest.mark.parametrize("confidence", [None, 0.7, 1.0])
def test_classifier(spark, confidence):
    rng, k, trials = random.Random(8), 6, 30
    refs = references(rng)
    queries = [(f"q{i}", s[5:55]) for i, (s, _) in enumerate(refs[:9])] + [("mixed", refs[0][0][:30] + refs[-4][0][30:60]), ("none", "N" * 20), ("short", "AC"), ("null", None)]
    score, candidates = plain_scores(refs, k)
    lineage = {";".join(x): x for _, x in refs if x}
    want = {}
    for q, s in queries:
        words = kmer_set(s, k)
        found = candidates(words)
        if not found:
            continue
        pick = lambda ws: max((round(score(t, ws), 9), t) for t in found)[1]  # noqa: B023, E731
        best = lineage[pick(words)]
        tries = [lineage[pick({w for w in words if chain(q, w, b // classify.PER_HASH) >> 3 * (b % classify.PER_HASH) & 7 == 0})] for b in range(trials)]
        conf = [sum(t[:r] == best[:r] for t in tries) / trials for r in range(1, len(best) + 1)]
        depth = len(best) if confidence is None else sum(c >= confidence for c in conf)
        want[q] = (";".join(best[:depth]) or "Unassigned", round(conf[max(depth, 1) - 1], 9), round(score(";".join(best), words), 6))
    model = classify.train(spark.createDataFrame(refs, "seq string, lineage array<string>"), k)
    out = classify.classify(spark.createDataFrame(queries, "qseqid string, seq string"), model, confidence=confidence, trials=trials)
    assert {r.qseqid: (r.taxonomy, round(r.confidence, 9), round(r.score, 6)) for r in out.collect()} == want and len(want) > 8


def test_classifier_of_nothing(spark):
    model = classify.train(spark.createDataFrame([], "seq string, lineage array<string>"))
    assert classify.classify(spark.createDataFrame([("q", "ACGTACGTACGT")], "qseqid string, seq string"), model).count() == 0


def removal_fixture():
    rng = random.Random(9)
    spike, other = dna(rng, 300), dna(rng, 120)
    back = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    noisy = lambda s, n: "".join(rng.choice("ACGT") if rng.random() < n else c for c in s)
    rows = [("exact", spike[40:140]), ("back", back(spike[100:220])), ("noisy", noisy(spike[10:130], 0.03)), ("loose", noisy(spike[10:130], 0.2)), ("half", spike[50:90] + dna(rng, 60)), ("over", dna(rng, 20) + spike[:50])]
    rows += [("gap", spike[20:70] + spike[75:130]), ("other", other[5:80]), ("no", dna(rng, 100)), ("short", "ACGT"), ("empty", ""), ("null", None)]
    return rows, [spike, other, None, "ACG"], back


def plain_matches(rows, refs, back, k, least, identity, overlap):
    both = {x for s in refs if s for x in (s, back(s))}
    words, out = set().union(*(kmer_set(s, k) for s in both)), set()
    for i, s in rows:
        if len(kmer_set(s, k) & words) < least:
            continue
        if identity is None:
            out.add(i)
            continue
        for ref in both:
            for shift in {b - a for a in range(len(s) - k + 1) for b in range(len(ref) - k + 1) if s[a : a + k] == ref[b : b + k]}:
                a = max(0, -shift)
                n = min(len(s), len(ref) - shift) - a
                if n >= (overlap or k) and sum(x == y for x, y in zip(s[a : a + n], ref[a + shift : a + shift + n])) / n >= identity - 1e-12:
                    out.add(i)
    return out


@pytest.mark.parametrize("k,least,identity,overlap", [(16, 4, None, None), (16, 4, 0.9, None), (12, 1, 0.95, 60), (12, 1, 0.5, None)])
def test_matching_reads(spark, k, least, identity, overlap):
    rows, refs, back = removal_fixture()
    df, ref = spark.createDataFrame(rows, "read_id string, seq string"), spark.createDataFrame([(s,) for s in refs], "seq string")
    got = {r.read_id for r in reads.matching_reads(df, ref, k, least, identity, overlap).collect()}
    want = plain_matches(rows, refs, back, k, least, identity, overlap)
    assert got == want and "exact" in want and "no" not in want
    kept = {r.read_id for r in reads.drop_matching(df, ref, k, least, identity, overlap).collect()}
    assert kept == {r[0] for r in rows} - want


def test_filter_passes_all_words_it_holds_and_is_refused_when_large(spark):
    ref = spark.createDataFrame([(dna(random.Random(1), 500),)], "seq string")
    held = reads.bloom_filter(ref, 20)
    seq = ref.first()[0]
    df = spark.createDataFrame([(str(i), seq[i : i + 60]) for i in range(0, 400, 7)] + [("no", dna(random.Random(2), 400))], "read_id string, seq string")
    assert {r.read_id for r in reads._may_match(df, held, 20, 41).collect()} == {str(i) for i in range(0, 400, 7)}
    assert reads.bloom_filter(ref, 20, most_bytes=10) is None
    assert reads.bloom_filter(ref.where(F.lit(False)), 20) is not None
