"""A word classifier of sequences with confidences: naive Bayes over the words that sequences have."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.staging import materialize
from taxaflow.operators.search import minimisers, seed_words, text_words

#: Trials that one 64-bit hash decides, three bits each: a word is in a trial's sample with a chance of 1 / 8.
PER_HASH = 21

#: Different words that a task counts before it hands them on.
HELD_WORDS = 500_000


@dataclass(frozen=True)
class Model:
    """``gains``: (taxon, word, gain) for the words that a taxon's references have; ``taxa``: (taxon, lineage, cost)."""

    gains: DataFrame
    taxa: DataFrame
    k: int


def word_bits(seqs: DataFrame, k: int, most_bytes: int = 64 << 20) -> np.ndarray | None:
    """One bit for each word of length k of the sequences (seq), 64 places for each; None if they would take more than ``most_bytes``."""
    words = seqs.where(F.length("seq") >= k).agg(F.sum(F.length("seq") - k + 1)).first()[0] or 0
    if 8 * words > most_bytes:
        return None
    held = np.zeros(max(1, words), np.int64)
    bit = F.pmod("word", F.lit(64 * len(held))).alias("_bit")
    slots = seed_words(seqs.withColumn("_id", F.lit(0)), ["_id"], k, 1).select(bit).groupBy(F.expr("_bit div 64").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("bits"))
    for r in slots.collect():
        held[r["slot"]] = r["bits"]
    return held


def counted_words(refs: DataFrame, k: int, held: np.ndarray | None) -> DataFrame:
    """(taxon, word, m): in how many references (taxon, seq) of a taxon each word is, in parts that tasks have counted.

    With ``held`` (see ``word_bits``) only words that pass it are cut out.
    """

    def run(batches):
        counts, n = {}, 0

        def handed_on():
            for taxon, c in counts.items():
                words = list(c)
                for a in range(0, len(words), 20_000):
                    some = words[a : a + 20_000]
                    yield pa.RecordBatch.from_arrays([pa.array([taxon] * len(some), pa.string()), pa.array(some, pa.string()), pa.array([c[w] for w in some], pa.int64())], ["taxon", "word", "m"])

        for b in batches:
            for taxon, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = range(len(s) - k + 1)
                if held is not None:
                    h = minimisers(s.encode("ascii", "replace"), k, 1)[0] % (64 * len(held))
                    at = np.nonzero(held[h >> 6] >> (h & 63) & 1)[0].tolist()
                c = counts.setdefault(taxon, Counter())
                n -= len(c)
                c.update(dict.fromkeys([s[i : i + k] for i in at], 1))
                n += len(c)
                if n >= HELD_WORDS:
                    yield from handed_on()
                    counts, n = {}, 0
        yield from handed_on()

    return refs.select("taxon", "seq").mapInArrow(run, "taxon string, word string, m long")


def train(references: DataFrame, k: int = 8, queries: DataFrame | None = None) -> Model:
    """A model of references (seq, lineage array). Those without a word of length k or without lineage take no part.

    With n(w) of N references having word w, its prior is (n(w) + 0.5) / (N + 1); a taxon of M references, m(w) of which have it,
    gives it the chance (m(w) + prior) / (M + 1). Only words with m(w) > 0 are kept: what one of them gains over a
    taxon without it is ln((m(w) + prior) / prior), and each word of a query costs ln(M + 1) besides. With ``queries`` (seq) the words
    that none of them has are left out (but for a few), which changes nothing for these queries.
    """
    refs = references.where((F.length("seq") >= k) & F.col("lineage").isNotNull()).select(F.array_join("lineage", ";").alias("taxon"), "lineage", "seq")
    held = None if queries is None else word_bits(queries, k)
    words = counted_words(refs, k, held).groupBy("taxon", "word").agg(F.sum("m").alias("m"))
    words = materialize(words, "taxon-words")
    total = refs.agg(F.count(F.lit(1)).alias("_all"))
    prior = words.groupBy("word").agg(F.sum("m").alias("_n")).crossJoin(F.broadcast(total)).select("word", ((F.col("_n") + 0.5) / (F.col("_all") + 1)).alias("prior"))
    gains = words.join(prior, "word").select("taxon", "word", F.log((F.col("m") + F.col("prior")) / F.col("prior")).alias("gain"))
    taxa = refs.groupBy("taxon").agg(F.first("lineage").alias("lineage"), F.log(F.count(F.lit(1)) + 1.0).alias("cost"))
    return Model(materialize(gains, "word-gains"), materialize(taxa, "taxa"), k)


def _sampled(trial: int) -> Column:
    return F.shiftrightunsigned(F.col(f"_h{trial // PER_HASH}"), 3 * (trial % PER_HASH)).bitwiseAND(F.lit(7)) == 0


def classify(queries: DataFrame, model: Model, *, confidence: float | None = 0.7, trials: int = 100) -> DataFrame:
    """(qseqid, taxonomy, confidence, score): the taxon of the highest score of each query (qseqid, seq), cut at the deepest rank that
    has the confidence.

    The score is the sum of the logarithms of the words' chances, less what is the same for all taxa; taxa that share no word
    with the query aren't looked at. Each trial scores the taxa by a sample of the query's words, drawn by a hash of query,
    word and trial; the confidence of a rank is the share of trials whose best taxon agrees up to it. All trials are
    sums of one group-by over the words in common. Without a rank of that confidence the taxonomy is ``Unassigned`` with the first rank's
    confidence; None leaves the lineage whole, with the confidence of its last rank. Ties go to the taxon of the greater name. Queries that share no word
    with any reference have no row.
    """
    hashes = -(-trials // PER_HASH)
    words = text_words(queries, ["qseqid"], model.k)
    words = words.withColumns({f"_h{i}": F.xxhash64(F.col("qseqid"), F.col("word"), F.lit(i)) for i in range(hashes)})
    drawn = lambda x: F.array(*[F.sum(F.when(_sampled(b), x).otherwise(F.lit(0.0))) for b in range(trials)])
    sizes = words.groupBy("qseqid").agg(F.count(F.lit(1)).alias("_n"), drawn(F.lit(1.0)).alias("_drawn"))
    sums = words.join(model.gains, "word").groupBy("qseqid", "taxon").agg(F.sum("gain").alias("_gain"), drawn(F.col("gain")).alias("_gains"))
    scored = sums.join(model.taxa, "taxon").join(sizes, "qseqid")
    cost = F.col("cost")
    scored = scored.select("qseqid", "taxon", "lineage", (F.col("_gain") - F.col("_n") * cost).alias("score"), F.zip_with("_gains", "_drawn", lambda g, n: g - n * cost).alias("_scores"))
    best = lambda x: F.max_by("lineage", F.struct(x, "taxon"))
    found = scored.groupBy("qseqid").agg(best(F.col("score")).alias("lineage"), F.max("score").alias("score"), F.array(*[best(F.col("_scores")[b]) for b in range(trials)]).alias("_best"))
    ranks = F.sequence(F.lit(1), F.size("lineage"))
    agrees = lambda r: F.size(F.filter("_best", lambda t: F.slice(t, 1, r) == F.slice(F.col("lineage"), 1, r))) / F.lit(float(trials))
    found = found.withColumn("_conf", F.transform(ranks, agrees))
    depth = F.size("lineage") if confidence is None else F.size(F.filter("_conf", lambda c: c >= confidence - 1e-12))  # shares don't grow with depth
    found = found.withColumn("_depth", depth)
    taxonomy = F.when(F.col("_depth") > 0, F.array_join(F.slice("lineage", 1, F.col("_depth")), ";")).otherwise(F.lit("Unassigned"))
    return found.select("qseqid", taxonomy.alias("taxonomy"), F.get("_conf", F.greatest(F.col("_depth"), F.lit(1)) - 1).alias("confidence"), "score")
