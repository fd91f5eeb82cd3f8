"""Quality classifier: a weak-label model over heuristic labellers and a hashed linear scorer trained on its posteriors."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quality_rules as rules
from .common import WordHashes, filter_rows, map_columns, materialize, mix64, tidy, word_hashes

#: (statistic, clean up to, bad from): a labeller votes 1 (clean) up to the first, -1 (bad) from the second, else 0.
LABELLERS = [
    ("symbol_share", 0.005, 0.05),
    ("dup_line_share", 0.05, 0.3),
    ("repeat_share", 0.02, 0.2),
    ("upper_share", 0.1, 0.25),
    ("punct_share", 0.08, 0.15),
    ("digit_share", 0.05, 0.2),
    ("top_word_share", 0.12, 0.25),
    ("echo_share", 0.02, 0.1),
]
DIMS = 1 << 16


def votes(stats: pd.DataFrame) -> np.ndarray:
    """Votes of LABELLERS, and of one on length: under 10 words is bad, from 50 words clean. Rows by labellers."""
    x = [np.where(stats[c] >= bad, -1, np.where(stats[c] <= clean, 1, 0)) for c, clean, bad in LABELLERS]
    x.append(np.where(stats["n_words"] < 10, -1, np.where(stats["n_words"] >= 50, 1, 0)))
    return np.stack(x, 1).astype(np.int8)


def pattern(v: np.ndarray) -> np.ndarray:
    """Votes as one integer, base 3."""
    return (v + 1).astype(np.int64) @ (3 ** np.arange(v.shape[1], dtype=np.int64))


def unpattern(code: np.ndarray, n: int) -> np.ndarray:
    return (code[:, None] // (3 ** np.arange(n, dtype=np.int64)) % 3).astype(np.int64)


@dataclass
class WeakLabels:
    """Two classes; each labeller has the chances of its three votes under either (clean: 1, bad: 0)."""

    prior: float
    table: np.ndarray  # class, labeller, vote

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        v = unpattern(codes, self.table.shape[1])
        each = np.log(self.table[:, np.arange(v.shape[1]), v]).sum(-1)  # class, row
        return 1 / (1 + np.exp(np.clip(each[0] + math.log(1 - self.prior) - each[1] - math.log(self.prior), -500, 500)))


def fit_weak_labels(codes: np.ndarray, counts: np.ndarray, n: int, rounds: int = 100, alarm: float = 0.001) -> WeakLabels:
    """Expectation-maximisation over the counts of distinct vote patterns, starting from any bad vote or none.

    Labellers are taken to be far better than chance: each one's share of bad votes under the clean class is held to
    ``alarm`` at most, so that a kind of junk which only one labeller sees isn't absorbed by the clean class.
    """
    v, w = unpattern(codes, n), counts.astype(float)
    clean = np.where((v == 0).any(1), 0.1, 0.9)
    for _ in range(rounds):
        table = np.empty((2, n, 3))
        for c, p in ((0, 1 - clean), (1, clean)):
            for k in range(3):
                table[c, :, k] = ((p * w)[:, None] * (v == k)).sum(0) + 1
        table /= table.sum(-1, keepdims=True)
        table[1, :, 0] = np.minimum(table[1, :, 0], alarm)
        table[1, :, 1:] *= ((1 - table[1, :, 0]) / table[1, :, 1:].sum(-1))[:, None]
        model = WeakLabels(float(np.clip((clean * w).sum() / max(w.sum(), 1), 0.01, 0.99)), table)
        new = model.posterior(codes)
        if np.abs(new - clean).max(initial=0) < 1e-9:
            break
        clean = new
    return model


#: Bytes to classes: A for A-Z, a for a-z and all above ASCII, 9 for digits; others stand for themselves.
_SHAPE = bytes(65 if 65 <= i <= 90 else 97 if 97 <= i <= 122 or i >= 128 else 57 if 48 <= i <= 57 else i for i in range(256))
_SHAPES = WordHashes()


def features(text: str | None) -> np.ndarray:
    """Hashed features of a whole text, two for each word: the word (or that it repeats the one before), and its shape.

    A shape is the word's bytes as classes, runs once.
    """
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    shape = np.frombuffer(raw.translate(_SHAPE), np.uint8)
    shape = shape[np.append(True, shape[1:] != shape[:-1])].tobytes() if len(shape) else b""
    words, shapes = word_hashes(text), shape.split()
    shapes = np.fromiter(map(_SHAPES.__getitem__, shapes), np.uint64, len(shapes))
    at = words % np.uint64(DIMS)
    at[1:][words[1:] == words[:-1]] = 0
    return np.concatenate([at, mix64(shapes) % np.uint64(DIMS)]).astype(np.int64)


def counted(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and the shares of the words that have them."""
    found, counts = np.unique(at, return_counts=True)
    return found, counts / max(len(at) / 2, 1)


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, passes: int = 12, rate: float = 0.5, seed: int = 7) -> np.ndarray:
    """Logistic regression on soft targets by AdaGrad; the last weight is the bias."""
    w, g, rng = np.zeros(DIMS + 1), np.full(DIMS + 1, 1e-3), np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            d = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w[at] @ x + w[-1]))))) - target[i]
            step = d * x
            g[at] += step * step
            w[at] -= rate * step / np.sqrt(g[at])
            g[-1] += d * d
            w[-1] -= rate * 0.1 * d / math.sqrt(g[-1])
    return w


@dataclass
class Scorer:
    weights: np.ndarray
    threshold: float = 0.5

    def score(self, texts) -> np.ndarray:
        """The chance of being bad."""
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            at = features(t)
            out[i] = self.weights[at].sum() / max(len(at) / 2, 1) + self.weights[-1]
        return 1 / (1 + np.exp(np.clip(out, -500, 500)))


def fit_scorer(
    docs: DataFrame, labels: DataFrame | None, *, key: str = "doc_id", text: str = "text", quality: str = "quality",
    sample_rows: int = 6000, good_loss: float = 0.003, seed: int = 7,
) -> tuple[Scorer, DataFrame | None]:
    """Fits the whole model.

    Votes are counted by pattern over all documents (3^9 patterns at most reach the driver), EM gives each pattern its
    posterior, and the linear scorer is trained on distinct texts chosen by hash, about ``sample_rows`` of the documents
    at most whatever their number, with these posteriors as soft labels. Its threshold covers all labelled documents: at most ``good_loss`` of the good ones
    score above it. Without good or bad labels the threshold is 0.5. Returns the scorer and the table (key, score) of
    all documents.
    """
    n = len(LABELLERS) + 1

    docs = tidy(docs, [key, text])

    def stats(texts):
        return pd.DataFrame([rules.statistics(t) for t in texts], columns=rules.BASE + rules.FEATURES)

    voted = materialize(map_columns(docs, [], [text], "code long", lambda texts: [pattern(votes(stats(texts)))]), "votes")
    counts = voted.groupBy("code").count().toPandas()
    if not len(counts):
        return Scorer(np.zeros(DIMS + 1)), None
    weak = fit_weak_labels(counts["code"].to_numpy(), counts["count"].to_numpy(), n)

    def sample(texts):
        got = [counted(features(t)) for t in texts]
        return pattern(votes(stats(texts))), [a.astype("<u2").tobytes() for a, _ in got], [x.astype("<f4").tobytes() for _, x in got]

    share = min(1.0, sample_rows / int(counts["count"].sum()))
    hashed = F.xxhash64(F.lit(seed), text)
    picked = docs.where(hashed <= int(share * 2**52) * 2**12 - 2**63 - 1).select(text, hashed.alias("_h")).dropDuplicates(["_h"])
    picked = map_columns(picked, ["_h"], [text], "code long, at binary, x binary", sample).toPandas().sort_values("_h")
    rows = [(np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(x, "<f4").astype(float)) for a, x in zip(picked["at"], picked["x"])]
    scorer = Scorer(fit_linear(rows, weak.posterior(picked["code"].to_numpy(np.int64))))
    scores = materialize(map_columns(docs, [key], [text], "score double", lambda texts: [scorer.score(texts)]), "quality-scores")
    if labels is not None:
        marks = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(key).agg((F.min(quality) > 0).alias("good"))
        found = rules.calibrate(scores.join(marks, key), "score", "good", good_loss)
        if math.isfinite(found):
            scorer.threshold = found
    return scorer, scores


def classify(docs: DataFrame, labels: DataFrame | None, *, key: str = "doc_id", **options) -> DataFrame:
    """key, score (chance of being bad) and kept of every row of ``docs``.

    Null and empty texts have no features and get the bias alone, long ones are read whole; null keys, repeated rows and ties are scored like any
    other; an empty table gives an empty result; extra columns are ignored.
    """
    scorer, scores = fit_scorer(docs, labels, key=key, **options)
    if scores is None:
        return tidy(docs, [key]).select(key, F.lit(None).cast("double").alias("score"), F.lit(True).alias("kept"))
    return scores.withColumn("kept", F.col("score") <= scorer.threshold)


def keep_documents(docs: DataFrame, labels: DataFrame | None, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, as they are."""
    docs = tidy(docs, [key, text])
    scorer, _ = fit_scorer(docs, labels, key=key, text=text, **options)
    return filter_rows(docs, [text], lambda texts: scorer.score(texts) <= scorer.threshold)
