"""Local search of sequences against subjects: shared words as seeds, joined; then banded affine alignments of what they name."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.batches import sliced, small_batches
from taxaflow.functions.sequence import reverse_complement
from taxaflow.functions.staging import materialize


@dataclass(frozen=True)
class Scoring:
    """Rewards and penalties with the constants of their score statistics; gaps of n cost ``gap_open`` + n * ``gap_extend``."""

    word: int
    match: int
    mismatch: int
    gap_open: int
    gap_extend: int
    lambda_: float
    k: float


#: The two usual parameter sets for nucleotides (word length, reward, penalty, gap costs, lambda, K).
SENSITIVE = Scoring(11, 2, -3, 5, 2, 0.625, 0.41)
CLOSE = Scoring(28, 2, -4, 0, 5, 0.64, 0.46)

_NONE = -(1 << 28)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def minimisers(raw: bytes, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the words of length k that have the least hash of some ``window`` words in a row.

    Two sequences that agree on k + window - 1 characters share one of them at the same place in that stretch. A shorter
    stretch than a window has its least word too.
    """
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = len(x) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = h * np.uint64(0x100000001B3) + x[i : n + i] + np.uint64(1)
    h = _mix(h)
    if window == 1:
        at = np.arange(n)
    elif n <= window:
        at = np.array([int(h.argmin())])
    else:
        rows = np.lib.stride_tricks.sliding_window_view(h, window)
        at = np.unique(np.concatenate([a + rows[a : a + 65536].argmin(1) + np.arange(len(rows[a : a + 65536])) for a in range(0, len(rows), 65536)]))
    return h[at].view(np.int64), at


def seed_words(seqs: DataFrame, key: list[str], k: int, window: int) -> DataFrame:
    """(key..., word, place): the minimisers of each sequence (seq)."""
    small_batches(seqs.sparkSession)
    fields = ", ".join(f"{c} {dict(seqs.dtypes)[c]}" for c in key)
    return seqs.select(*key, "seq").mapInArrow(lambda batches: _seeds(batches, key, k, window), f"{fields}, word long, place int")


def _seeds(batches, key: list[str], k: int, window: int):
    """The words' batches, each of a few sequences: a task holds the words of these alone."""
    for b in sliced(batches, ["seq"]):
        found = [minimisers(s.encode("ascii", "replace") if s else b"", k, window) for s in b.column(b.num_columns - 1).to_pylist()]
        own = pa.array(np.repeat(np.arange(b.num_rows), [len(h) for h, _ in found]))
        yield pa.RecordBatch.from_arrays([*(b.column(i).take(own) for i in range(len(key))), pa.array(np.concatenate([np.zeros(0, np.int64), *(h for h, _ in found)])), pa.array(np.concatenate([np.zeros(0, np.int32), *(p.astype(np.int32) for _, p in found)]))], [*key, "word", "place"])


def text_words(seqs: DataFrame, key: list[str], k: int, places: bool = False) -> DataFrame:
    """(key..., word): the distinct words of length k of each sequence (seq), or with ``places`` all of them and where they begin (from 0).

    One walk over each sequence, 20,000 words to a batch at most.
    """
    small_batches(seqs.sparkSession)
    fields = ", ".join(f"{c} {dict(seqs.dtypes)[c]}" for c in key)

    names = [*key, "word", *(["place"] if places else [])]

    def run(batches):
        for b in sliced(batches, ["seq"]):
            for r, s in enumerate(b.column(b.num_columns - 1).to_pylist()):
                found = [s[i : i + k] for i in range(len(s) - k + 1)] if s else []
                found = found if places else list(dict.fromkeys(found))
                for a in range(0, len(found), 20_000):
                    some = found[a : a + 20_000]
                    own = [b.column(i).take(pa.array([r] * len(some))) for i in range(len(key))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(some, pa.string()), *([pa.array(range(a, a + len(some)), pa.int32())] if places else [])], names)

    return seqs.select(*key, "seq").mapInArrow(run, f"{fields}, word string" + (", place int" if places else ""))


def _salted(words: DataFrame, frequent: int) -> DataFrame:
    """(word, parts): words on more than ``frequent`` places, and the parts that these are dealt to."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > frequent)
    return counts.select("word", F.ceil(F.col("n") / frequent).cast("int").alias("parts"))


def banded(q: np.ndarray, s: np.ndarray, scoring: Scoring) -> dict[str, np.ndarray]:
    """The best local alignment of each pair (row) of q, filled up with 0, and s, filled up with 1, in which a character of q at i
    meets those of s from i on, as many as s is longer than q.

    Cells are (row, diagonal); gaps along a row are a running maximum. Beside the score, each state carries the matches, mismatches,
    gap columns and start of its alignment; of equal scores the one with the shorter gap and the earlier end is taken.
    """
    n, width = len(q), s.shape[1] - q.shape[1] + 1
    shape, at = (n, width), np.arange(width)
    zero = np.zeros(shape, np.int64)
    fields = ("score", "matches", "mismatches", "gaps", "start")
    state = lambda: [np.full(shape, _NONE, np.int64), zero, zero, zero, zero]
    h, up = state(), state()
    h[0] = zero
    best = {c: np.zeros(n, np.int64) for c in (*fields, "end")}
    rows = np.arange(n)
    choose = lambda take, a, b: [np.where(take, x, y) for x, y in zip(a, b)]
    for i in range(q.shape[1]):
        same = q[:, i, None] == s[:, i : i + width]
        fresh = h[0] <= 0
        diag = [np.where(fresh, 0, h[0]) + np.where(same, scoring.match, scoring.mismatch), np.where(fresh, 0, h[1]) + same, np.where(fresh, 0, h[2]) + ~same, np.where(fresh, 0, h[3]), np.where(fresh, i, h[4])]
        # A gap in the subject comes from the row above, one diagonal further on.
        over = [np.concatenate([x[:, 1:], np.full((n, 1), _NONE if c == 0 else 0)], 1) for c, x in enumerate(h)]
        far = [np.concatenate([x[:, 1:], np.full((n, 1), _NONE if c == 0 else 0)], 1) for c, x in enumerate(up)]
        opened = over[0] - scoring.gap_open - scoring.gap_extend
        up = choose(opened >= far[0] - scoring.gap_extend, [opened, *over[1:]], [far[0] - scoring.gap_extend, *far[1:]])
        up[3] = up[3] + 1
        new = choose(diag[0] >= up[0], diag, up)
        # A gap in the query comes from the same row: the best place to open it, as a running maximum of (score, place).
        lifted = (new[0] + scoring.gap_extend * at) * width + at
        ran = np.maximum.accumulate(lifted, 1)
        came = np.concatenate([np.zeros((n, 1), np.int64), ran[:, :-1] % width], 1)
        side = np.concatenate([np.full((n, 1), _NONE), ran[:, :-1] // width - scoring.gap_extend * at[1:] - scoring.gap_open], 1)
        take = side > new[0]
        if take.any():
            left = [np.take_along_axis(x, came, 1) for x in new[1:]]
            new = choose(take, [side, *left[:2], left[2] + at - came, left[3]], new)
        h = new
        top = h[0].argmax(1)
        better = h[0][rows, top] > best["score"]
        for c, x in zip(fields, h):
            best[c] = np.where(better, x[rows, top], best[c])
        best["end"] = np.where(better, i + 1, best["end"])
    return best


def local_search(
    queries: DataFrame, subjects: DataFrame, scoring: Scoring = SENSITIVE, *, max_targets: int = 500, evalue: float = 10.0, both_strands: bool = True, band: int = 16, window: int | None = None, frequent: int = 4096,
) -> DataFrame:
    """Hits of queries (qseqid, seq) among subjects (sseqid, seq and, as they have them, staxids and stitle), in the columns of hit files.

    A query meets the subjects that share ``scoring.word`` characters with it, on either strand; for each the best
    local alignment with affine gaps is sought within ``band`` diagonals of such a seed. Hits up to the e-value are ranked by
    score (ties: sseqid), the first ``max_targets`` of a query stay; hit_ord is the rank. Seeds are joined by minimisers, so that
    sampling them loses none; those on more than ``frequent`` places of the subjects are dealt to parts, each
    of which meets all queries' uses of it. Only the stretch of a subject that a band can reach is sent to be aligned.
    Null and empty sequences have no hits; letters are compared as they are, and none but ASCII ones match.
    """
    window = window or max(1, scoring.word // 2 - 1 if scoring.word > 16 else 1)
    k = scoring.word - window + 1
    plain = F.regexp_replace("seq", r"[^\x00-\x7F]", "?")
    q = queries.select("qseqid", F.lit(1).alias("strand"), plain.alias("seq"))
    q = q.unionByName(q.select("qseqid", F.lit(-1).alias("strand"), reverse_complement(F.col("seq")).alias("seq"))) if both_strands else q
    q = q.where(F.length("seq") > 0)
    own = materialize(seed_words(q, ["qseqid", "strand"], k, window).withColumnRenamed("place", "_q"), "query-words")
    theirs = seed_words(subjects.select("sseqid", "seq"), ["sseqid"], k, window).withColumnRenamed("place", "_s")
    theirs = materialize(theirs.join(own.select("word").distinct(), "word", "left_semi"), "subject-words")
    salts = materialize(_salted(theirs, frequent), "frequent-words")
    parts = F.coalesce("parts", F.lit(1))
    left = own.join(salts, "word", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    right = theirs.join(salts, "word", "left").withColumn("_part", F.pmod(F.xxhash64("sseqid", "_s"), parts).cast("int")).drop("parts")
    # Diagonals are dealt to strips; a band round a strip covers the bands round all seeds in it.
    strip = F.floor((F.col("_s") - F.col("_q")) / F.lit(2.0 * band)).cast("int")
    met = left.join(right, ["word", "_part"]).select("qseqid", "strand", "sseqid", strip.alias("_strip")).distinct()
    first = F.col("_strip") * (2 * band) - band
    wide = 4 * band
    both = met.join(q, ["qseqid", "strand"]).withColumnRenamed("seq", "_query")
    both = both.join(subjects.select("sseqid", plain.alias("_subject")), "sseqid")
    n = F.length("_query")
    cut = F.concat(F.repeat(F.lit("\x01"), F.greatest(-first, F.lit(0))), F.substring("_subject", F.greatest(first, F.lit(0)) + 1, n + wide - 1 + F.least(first, F.lit(0))))
    pairs = both.select("qseqid", "sseqid", "strand", "_query", cut.alias("_stretch"))
    kinds = {c: dict(pairs.dtypes)[c] for c in ("qseqid", "sseqid", "strand")}

    held = ["score", "matches", "mismatches", "gaps", "start", "end"]

    def align(batches):
        for b in sliced(batches, ["_query", "_stretch"], 128):
            qs, ss = ([x.encode("ascii", "replace") for x in b.column(i).to_pylist()] for i in (3, 4))
            longest = max(map(len, qs))
            x = np.frombuffer(b"".join(t.ljust(longest, b"\0") for t in qs), np.uint8).reshape(len(qs), -1)
            y = np.frombuffer(b"".join(t.ljust(longest + wide - 1, b"\x01") for t in ss), np.uint8).reshape(len(ss), -1)
            r = banded(x, y, scoring)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(r[c]) for c in held)], [*kinds, *held])

    found = pairs.mapInArrow(align, ", ".join(f"{c} {t}" for c, t in kinds.items()) + "".join(f", {c} long" for c in held))
    best = F.max_by(F.struct(*held, "strand"), F.struct("score", "strand", "matches", (-F.col("start")).alias("s"))).alias("h")
    best = found.where("score > 0").groupBy("qseqid", "sseqid").agg(best).select("qseqid", "sseqid", "h.*")
    size = subjects.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("_all"))
    best = best.join(queries.select("qseqid", F.length("seq").alias("_n")), "qseqid").crossJoin(F.broadcast(size))
    bits = (scoring.lambda_ * F.col("score") - float(np.log(scoring.k))) / float(np.log(2))
    best = best.withColumn("bitscore", bits).withColumn("evalue", F.col("_n") * F.col("_all") * F.pow(F.lit(2.0), -F.col("bitscore"))).where(F.col("evalue") <= evalue)
    order = Window.partitionBy("qseqid").orderBy(F.desc("score"), "sseqid")
    best = best.withColumn("hit_ord", F.row_number().over(order).cast("long")).where(F.col("hit_ord") <= max_targets)
    named = [c for c in ("staxids", "stitle") if c in subjects.columns]
    best = best.join(subjects.select("sseqid", *named), "sseqid") if named else best
    share = lambda x, of: F.round(100 * x / of, 3)
    length = F.col("matches") + F.col("mismatches") + F.col("gaps")
    return best.select(
        "qseqid", "sseqid", share(F.col("matches"), length).alias("pident"), length.cast("int").alias("length"), F.col("mismatches").cast("int").alias("mismatch"),
        "evalue", F.round("bitscore", 1).alias("bitscore"), *named, share(F.col("end") - F.col("start"), F.col("_n")).alias("qcovs"), "hit_ord", F.col("score"), "strand",
    )


def searcher(queries: DataFrame, subjects: DataFrame, depths: list[int], **options):
    """A function for ``hits.deepen``: searches the sequences of the queries it is given at the depth of its round."""

    def search(need: DataFrame, i: int) -> DataFrame:
        return local_search(queries.join(need.select("qseqid"), "qseqid", "left_semi"), subjects, max_targets=depths[i], **options)

    return search
