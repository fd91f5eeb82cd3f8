import random
from collections import Counter

import numpy as np
import pytest

from taxaflow.llm import jaccard_forest as jf
from tests.llm.helpers import documents


def corpus():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [None, "", " \n", "short text", "short text", "short  text", "one", "x " * 5000]
    for g in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.choice([1, 2, 3, 40])):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = f"new{rng.random()}"
            texts.append(" ".join(t))
        texts.append(" ".join(base))
        texts.append(" ".join(base))
    return texts


def brute(texts):
    sets = [set(jf.shingles(t, 5).tolist()) for t in texts]
    n, up = [0] * len(texts), list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                n[i] += 1
                n[j] += 1
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) for i in range(len(texts))], n


@pytest.mark.parametrize("block", [256, 9])
def test_links_and_classes_equal_brute_force(spark, block):
    texts = corpus()
    classes, links = brute(texts)
    got = {r.doc_id: r for r in jf.near_copies(documents(spark, texts), block=block).collect()}
    assert [got[i].n_links for i in range(len(texts))] == links
    assert [got[i].class_id for i in range(len(texts))] == classes
    assert all(got[i].copy_id == next(j for j, t in enumerate(texts) if t == texts[i]) for i in range(3, len(texts)))


def test_one_of_each_class_stays(spark):
    texts = corpus()
    classes, _ = brute(texts)
    docs = documents(spark, texts)
    kept = jf.keep_documents(docs.unionByName(docs.where("doc_id > 20")).unionByName(documents(spark, [None]).selectExpr("cast(null as long) doc_id", "'a b c d e f g' text", "lang", "source", "n_chars")))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(classes)) and ids.count(None) == 1


def test_nothing(spark):
    docs = documents(spark, corpus())
    assert jf.near_copies(docs.where("false")).count() == 0 and jf.keep_documents(docs.where("false")).count() == 0
    assert jf.keep_documents(documents(spark, [None, "", " "])).count() == 3


def test_no_prefix_is_shorter_than_the_threshold_needs():
    d = jf.shortest_prefix(0.8, 20, 0.9999, 8)
    assert 1 - (1 - 0.8**d) ** 20 >= 0.9999 > 1 - (1 - 0.8 ** (d + 1)) ** 20


def paths_of_pairs(similarity, n, trees=20, longest=8):
    rng = np.random.default_rng(8)
    a = rng.integers(0, 2**16, (n, trees, longest)).astype(np.uint16)
    return np.concatenate([a, np.where(rng.random(a.shape) < similarity, a, a + np.uint16(1))]), np.arange(n)[:, None] + [0, n]


def test_recall_is_estimated_from_what_was_met():
    for s in (0.8, 0.85, 0.95):
        paths, pairs = paths_of_pairs(s, 4000)
        for d in (8, 6, 4):
            here = jf.nodes(paths, d)
            met = (here[pairs[:, 0]] == here[pairs[:, 1]]).any(1)
            guess = jf.expected_recall(jf.similarity_counts(paths, pairs[met], 0.8), d, 0.8, 20)
            assert abs(met.mean() - (1 - (1 - s**d) ** 20)) < 0.01 and met.mean() - 0.03 < guess < met.mean() + 0.005
    assert jf.expected_recall(np.zeros(jf.BINS + 1), 8, 0.8, 20) == 0


def test_pairs_are_new_at_their_longest_prefix_only():
    paths, _ = paths_of_pairs(0.8, 60)
    n, seen = len(paths), Counter()
    for d in range(8, 3, -1):
        for t in range(20):
            here = jf.nodes(paths, d)[:, t]
            for i, j in np.argwhere(jf.new_pairs(paths, np.zeros(n), t, d, False)):
                assert here[i] == here[j]
                seen[i, j] += 1
    low = jf.nodes(paths, 4)
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if (low[i] == low[j]).any()}
    assert set(seen) == want and set(seen.values()) == {1}


def test_shortening_goes_on_while_links_are_missed(spark, monkeypatch):
    """Texts with one word changed need short prefixes only where they are short."""
    rng, went = random.Random(3), []
    monkeypatch.setattr(jf, "materialize", lambda df, name, known=jf.materialize: went.append(name) or known(df, name))
    for words, changed in ((2000, 1), (60, 1)):
        texts = []
        for _ in range(60):
            t = [f"v{rng.randrange(5000)}" for _ in range(words)]
            texts += [" ".join(t), " ".join(t[: words // 2] + ["other"] * changed + t[words // 2 + changed :])]
        went.clear()
        assert [r.n_links for r in jf.near_copies(documents(spark, texts)).collect()] == [1] * 120
        assert went.count("units") == 1 if words == 2000 else went.count("units") > 1


def test_steps_agree_as_often_as_sets():
    forest = jf.Forest(400, 1, 3)
    a, b = np.arange(1, 901, dtype=np.uint64), np.arange(101, 1001, dtype=np.uint64)
    a, b = jf.mix64(a), jf.mix64(b)
    assert abs((forest.signature(a) == forest.signature(b)).mean() - 0.8) < 0.07
    assert (forest.read([forest.signature(a).tobytes()])[0] == forest.signature(a)).all()


def test_intersections_either_way():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 80, 50).astype(np.uint64)) for _ in range(30)]
    pairs = np.array([(i, j) for i in range(30) for j in range(i + 1, 30)])
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in pairs]
    assert jf.common_counts(sets, pairs).tolist() == want and jf.common_counts(sets, pairs[:20]).tolist() == want[:20]


def test_components_of_long_chains(spark):
    import hashlib

    names = [hashlib.md5(str(i).encode()).digest() for i in range(200)]
    edges = [(bytearray(names[i]), bytearray(names[i + 1])) for i in range(199) if i != 100]
    got = jf.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    roots = {bytes(r.node): bytes(r.root) for r in got}
    assert {roots[n] for n in names[:101]} == {min(names[:101])} and {roots[n] for n in names[101:]} == {min(names[101:])}


def test_recall_on_the_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    sets, holders = [set(jf.shingles(r.text, 5).tolist()) for r in rows], {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    both = Counter((i, j) for h in holders.values() for a, i in enumerate(h) for j in h[a + 1 :])
    links = Counter(k for (i, j), n in both.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n) - 1e-9 for k in (i, j))
    got = {r.doc_id: r.n_links for r in jf.near_copies(spark.createDataFrame(rows)).collect()}
    found, want = sum(got.values()), sum(links.values())
    print(f"recall over {len(rows)} documents: {found} of {want} links")
    assert all(got[r.doc_id] <= links[i] for i, r in enumerate(rows)) and found >= 0.999 * want > 0
