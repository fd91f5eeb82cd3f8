import re
from collections import Counter

import numpy as np
import pytest

from taxaflow.llm import quality_model, quality_rules, queries
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


ODD = [None, "", " \n\t", "a", "a a a a a a a", "x\x0by\x1cz w", "l1 a b c d\nl1 a b c d\n\nl1 a b c d", "é #*$%&|<> \U0001f600", "w " * 30_000]


@pytest.mark.parametrize("text", ODD)
def test_statistics(text):
    assert quality_rules.statistics(text)[:5] == plain(text)


def test_op8_base_and_verdicts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op8_rules(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, dup, repeat = plain(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n) and not (r.base_failed and r.kept)
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


def test_forest_isolates_outliers():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    s = quality_rules.fit_forest(x, 100, 256, 1).score(x)
    assert s.argmax() == 500 and s[500] > 0.65 and np.median(s) < 0.5
    assert (quality_rules.fit_forest(x[:0], 10, 256, 1).score(x) == 1).all()


def test_rules_without_labels_and_odd_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = documents(spark, ODD)
    got = {r.doc_id: r for r in quality_rules.judge_documents(docs, labels).collect()}
    assert len(got) == len(ODD) and not got[0].kept and got[0].base_failed
    assert quality_rules.judge_documents(docs.where("false"), labels).count() == 0
    kept = quality_rules.keep_documents(docs.unionByName(documents(spark, ["one two three four five six seven eight nine ten"])), labels)
    assert kept.columns == docs.columns and [len(WORD.findall(r.text)) for r in kept.collect()] == [10]


def test_calibration_holds_the_loss(spark):
    rows = [(i / 1000, True) for i in range(1000)] + [(0.9995, False)] * 50
    df = spark.createDataFrame(rows, "score double, good boolean")
    t = quality_rules.calibrate(df, "score", "good", 0.01)
    assert sum(s > t for s, g in rows if g) <= 10 and all(s > t for s, g in rows if not g)


def test_weak_labels_recover_classes():
    rng = np.random.default_rng(2)
    clean = rng.random(20_000) < 0.85
    v = np.zeros((20_000, 5), int)
    for j in range(5):
        fires = np.where(clean, rng.random(20_000) < 0.0005, rng.random(20_000) < 0.5)
        v[:, j] = np.where(fires, -1, 1)
    codes, where, counts = np.unique(quality_model.pattern(v), return_inverse=True, return_counts=True)
    model = quality_model.fit_weak_labels(codes, counts, 5)
    p = model.posterior(codes)[where]
    assert abs(model.prior - 0.85) < 0.05 and ((p > 0.5) == clean).mean() > 0.97
    assert (quality_model.unpattern(quality_model.pattern(v[:9]), 5) - 1 == v[:9]).all()


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    kept = {r.doc_id: r.kept for r in quality_model.classify(docs, seen).collect()}
    held = [(kept[r.doc_id], r.quality) for r in labels.where("doc_id % 2 = 1").collect()]
    assert np.mean([k for k, q in held if q == 1]) > 0.97 and np.mean([k for k, q in held if q == 0]) < 0.4


def test_classifier_on_odd_rows(spark):
    docs = documents(spark, ODD)
    got = quality_model.classify(docs, None).collect()
    assert len(got) == len(ODD) and all(r.score is not None for r in got)
    assert quality_model.classify(docs.where("false"), None).count() == 0
    assert quality_model.keep_documents(docs, None).columns == docs.columns


def test_op8_verdicts_equal_a_plain_forest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rules = quality_rules.fit_rules(quality_rules.with_statistics(docs, ["doc_id"]), labels)

    def path(tree, x, at=0):
        feature, cut, left, right, length = tree
        return length[at] if feature[at] < 0 else path(tree, x, left[at] if x[feature[at]] < cut[at] else right[at])

    texts, odd = {r.doc_id: r.text for r in docs.collect()}, 0
    for r in queries.op8_rules(spark, SF).collect()[::5]:
        x = quality_rules.statistics(texts[r.doc_id])[5:]
        score = 2 ** -(np.mean([path(t, x) for t in rules.forest.trees]) / rules.forest.norm)
        odd += score > rules.threshold
        assert abs(score - rules.threshold) < 1e-9 or r.kept == (not r.base_failed and score <= rules.threshold)
    assert 0 < odd and len(rules.forest.trees) == 300


def test_op7_equals_plain_counting(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    scorer, scores = quality_model.fit_scorer(docs, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op7_quality(spark, SF).collect()
    assert len(rows) == len(texts) and 0 < sum(not r.kept for r in rows) < len(rows) / 2

    def at(word):
        return int(quality_model.mix64(np.array([word], np.uint64))[0] % quality_model.DIMS)

    from xxhash import xxh3_64_intdigest as h

    for r in rows[::20]:
        words, last, total = texts[r.doc_id].encode().split(), None, 0.0
        for w in words:
            shape = re.sub(rb"(.)\1+", rb"\1", re.sub(rb"[a-z\x80-\xff]", b"a", re.sub(rb"[A-Z]", b"A", re.sub(rb"[0-9]", b"9", w))), flags=re.S)
            total += scorer.weights[0 if w == last else h(w) % quality_model.DIMS] + scorer.weights[at(h(shape))]
            last = w
        score = 1 / (1 + np.exp(np.clip(total / max(len(words), 1) + scorer.weights[-1], -500, 500)))
        assert abs(score - r.score) < 1e-9 and (abs(score - scorer.threshold) < 1e-9 or r.kept == (score <= scorer.threshold))


def test_posteriors_equal_bayes():
    codes = np.arange(27)
    model = quality_model.fit_weak_labels(codes, np.arange(1, 28), 3)
    for code, p in zip(codes, model.posterior(codes)):
        votes = [code // 3**k % 3 for k in range(3)]
        bad, good = (share * np.prod([model.table[c, k, v] for k, v in enumerate(votes)]) for c, share in ((0, 1 - model.prior), (1, model.prior)))
        assert abs(p - good / (good + bad)) < 1e-9
