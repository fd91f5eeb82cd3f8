"""Quality rules: rule statistics of whole texts and an isolation forest over them."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_rows, map_columns, materialize, shingle_hashes, tidy, word_hashes

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_PUNCT = b"!\"'(),-./:;?@[]^_`{}~+=\\"
_DIGITS = b"0123456789"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the forest splits on: shares, damped by ``DAMP`` words so that short texts aren't odd by chance.
FEATURES = ["word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "punct_share", "digit_share", "top_word_share", "echo_share"]
DAMP = 20
STATS_SCHEMA = ", ".join([*(f"{c} long" for c in BASE), *(f"{c} double" for c in FEATURES)])


def statistics(text: str | None) -> tuple:
    """BASE and FEATURES of one text; null and empty texts have zeros throughout."""
    if not text:
        return (0,) * len(BASE) + (0.0,) * len(FEATURES)
    words = word_hashes(text)
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    repeat = 0
    if n >= 5:
        windows = shingle_hashes(words, 5)
        _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[where] > 1
        if twice.any():
            covered = np.zeros(n, bool)
            for k in range(5):
                covered[k : k + len(twice)] |= twice
            repeat = int(covered.sum())
    raw = text.encode("utf-8", "surrogatepass")
    upper, punct, digits = (len(raw) - len(raw.translate(None, x)) for x in (_UPPER, _PUNCT, _DIGITS))
    top = int(np.unique(words, return_counts=True)[1].max()) if n else 0
    echo = int((words[1:] == words[:-1]).sum())
    per_char, per_word = 1 / (chars + 5 * DAMP), 1 / (n + DAMP)
    return (
        n, chars, symbols, dup, repeat,
        (chars + 5 * DAMP) * per_word, symbols * per_char, dup / (len(lines) + 5), repeat * per_word, upper * per_char,
        punct * per_char, digits * per_char, top * per_word, echo * per_word,
    )


def base_failed(n_words, n_repeat_words):
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the statistics of each text, one row for each row."""
    return map_columns(docs, keep, [text], STATS_SCHEMA, lambda texts: zip(*map(statistics, texts)) if texts else [[]] * len(BASE + FEATURES))


class Forest:
    """Isolation trees, laid end to end: feature (-1: leaf), threshold, children, and at leaves the path length."""

    def __init__(self, trees: list = (), norm: float = 1.0):
        self.norm, self.roots = norm, np.cumsum([0, *(len(t[0]) for t in trees)])[:-1]
        self.feature, self.cut, self.length = (np.concatenate([t[i] for t in trees]) if trees else np.zeros(0) for i in (0, 1, 4))
        self.child = np.concatenate([np.stack(t[2:4], 1) + r for t, r in zip(trees, self.roots)]).ravel() if trees else np.zeros(0)

    @property
    def trees(self) -> list:
        """The trees one by one, as ``grow`` makes them."""
        spans = zip(self.roots, [*self.roots[1:], len(self.feature)])
        return [(self.feature[a:b], self.cut[a:b], self.child[2 * a : 2 * b : 2] - a, self.child[2 * a + 1 : 2 * b : 2] - a, self.length[a:b]) for a, b in spans]

    def score(self, x: np.ndarray, rows: int = 256) -> np.ndarray:
        """2^(-mean path length / expected one): near 1 is odd, under 0.5 is ordinary. All trees are walked at once,
        by ``rows`` rows at a time."""
        return np.concatenate([np.ones(0), *(np.exp2(-self._paths(x[i : i + rows]) / self.norm) for i in range(0, len(x), rows))])

    def _paths(self, x: np.ndarray) -> np.ndarray:
        n, width = x.shape
        if not len(self.roots):
            return np.zeros(n)
        at, values = np.repeat(self.roots, n), np.ascontiguousarray(x).ravel()
        todo = np.flatnonzero(self.feature[at] >= 0)
        while len(todo):
            node = at[todo]
            right = values[todo % n * width + self.feature[node]] >= self.cut[node]
            at[todo] = node = self.child[2 * node + right]
            todo = todo[self.feature[node] >= 0]
        return self.length[at].reshape(-1, n).mean(0)


def expected_path(n: int) -> float:
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> tuple:
    feature, cut, left, right, length, todo = [], [], [], [], [], [(x, 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(feature)
        if parent >= 0:
            (left, right)[side][parent] = me
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        open_ = np.flatnonzero(high > low)
        for a, v in ((feature, -1), (cut, 0.0), (left, 0), (right, 0), (length, depth + expected_path(len(rows)))):
            a.append(v)
        if depth < limit and len(rows) > 1 and len(open_):
            f = int(rng.choice(open_))
            c = rng.uniform(low[f], high[f])
            feature[me], cut[me] = f, c
            todo += [(rows[rows[:, f] < c], depth + 1, me, 0), (rows[rows[:, f] >= c], depth + 1, me, 1)]
    return np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(length)


def fit_forest(x: np.ndarray, trees: int, sample: int, seed: int) -> Forest:
    rng, n = np.random.default_rng(seed), min(sample, len(x))
    if n < 2:
        return Forest()
    limit = 2 * math.ceil(math.log2(n))
    return Forest([grow(x[rng.choice(len(x), n, replace=False)], rng, limit) for _ in range(trees)], expected_path(n))


@dataclass
class Rules:
    forest: Forest
    threshold: float

    def rejects(self, stats: pd.DataFrame) -> np.ndarray:
        return self.forest.score(stats[FEATURES].to_numpy(float)) > self.threshold


def calibrate(scored: DataFrame, score: str, good: str, loss: float, bins: int = 10_000, dearness: float = 20.0) -> float:
    """The threshold above which rows are rejected, from the counts of all labelled rows.

    Of the thresholds above which at most ``loss`` of the good rows score, the one with the best share of bad rows above
    it, less ``dearness`` times the share of good ones (the middle, where several do). The driver gets two counts for
    each of ``bins`` equal steps of the score. Without good or bad rows: infinity.
    """
    bin_ = F.least(F.lit(bins - 1), F.floor(F.col(score) * bins)).cast("int")
    counts = scored.groupBy(bin_.alias("bin")).agg(F.count_if(F.col(good)).alias("good"), F.count_if(~F.col(good)).alias("bad")).collect()
    goods, bads = np.zeros(bins), np.zeros(bins)
    for r in counts:
        goods[r["bin"]], bads[r["bin"]] = r["good"], r["bad"]
    if not goods.sum() or not bads.sum():
        return math.inf
    lost = np.append(np.cumsum(goods[::-1])[::-1], 0) / goods.sum()  # by the threshold's bin: shares at it or above
    caught = np.append(np.cumsum(bads[::-1])[::-1], 0) / bads.sum()
    worth = np.where(lost <= loss, caught - dearness * lost, -np.inf)
    best = np.flatnonzero(worth >= worth.max() - 1e-12)
    return float(best[len(best) // 2]) / bins


def fit_rules(
    stats: DataFrame, labels: DataFrame, *, key: str = "doc_id", quality: str = "quality", sample_rows: int = 20_000,
    trees: int = 300, tree_sample: int = 1024, odd_share: float = 0.006, good_loss: float = 0.006, seed: int = 8,
) -> Rules:
    """Fits the forest on at most ``sample_rows`` labelled rows and its threshold on all of them (see ``calibrate``).

    Trees see ``tree_sample`` rows of which ``odd_share`` are labelled bad, so that what is bad stays rare among them
    and is isolated early. A key with several labels counts as bad if one of them says so; null keys and labels are
    left out. Without good or bad labels no row is rejected by the forest.
    """
    marks = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(key).agg((F.min(quality) > 0).alias("_good"))
    known = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select(key, *FEATURES).join(marks, key)
    known = materialize(known, "labelled-statistics")
    share = min(1.0, 2 * sample_rows / max(known.count(), 1))  # so that few more rows than wanted are sorted and sent
    hashed = known.withColumn("_h", F.xxhash64(F.lit(seed), key)).where(F.col("_h") <= int(share * 2**52) * 2**12 - 2**63 - 1)
    picked = hashed.orderBy("_h", key).limit(sample_rows).toPandas()
    good, bad = (picked.loc[picked["_good"] == v, FEATURES].to_numpy(float) for v in (True, False))
    if not len(good) or not len(bad):
        return Rules(Forest(), math.inf)
    n_bad = min(len(bad), max(1, round(odd_share / (1 - odd_share) * len(good))))
    rng = np.random.default_rng(seed)
    forest = fit_forest(np.vstack([good, bad[rng.choice(len(bad), n_bad, replace=False)]]), trees, tree_sample, seed)
    schema = "score double, good boolean"

    def score(batches):
        for b in batches:
            yield pd.DataFrame({"score": forest.score(b[FEATURES].to_numpy(float)), "good": b["_good"]})

    return Rules(forest, calibrate(known.select(*FEATURES, "_good").mapInPandas(score, schema), "score", "good", good_loss))


def judge_documents(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """key, the base statistics, base_failed and kept of every row of ``docs``.

    Words are runs of characters other than ASCII white space, over whole texts. base_failed: fewer than 10 words, or
    more than a fifth of them in 5-word windows that the text repeats. kept is false for those, and for texts that the
    isolation forest finds odd. Null and empty texts have no words and fail; repeated rows, null keys and ties are
    judged like any other; an empty table gives an empty result; extra columns are ignored.
    """
    stats = materialize(with_statistics(tidy(docs, [key, text]), [key], text), "rule-statistics")
    rules = fit_rules(stats, labels, key=key, **options)

    def verdict(*columns):
        b = pd.DataFrame(dict(zip(BASE + FEATURES, columns)))
        failed = base_failed(b["n_words"], b["n_repeat_words"])
        return failed, ~failed & ~rules.rejects(b)

    return map_columns(stats, [key, *BASE], BASE + FEATURES, "base_failed boolean, kept boolean", verdict)


def keep_documents(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, as they are."""
    docs = tidy(docs, [key, text])
    stats = materialize(with_statistics(docs, [key], text), "rule-statistics")
    rules = fit_rules(stats, labels, key=key, **options)

    def kept(texts):
        stats = pd.DataFrame([statistics(t) for t in texts], columns=BASE + FEATURES)
        return ~base_failed(stats["n_words"], stats["n_repeat_words"]) & ~rules.rejects(stats)

    return filter_rows(docs, [text], kept)
