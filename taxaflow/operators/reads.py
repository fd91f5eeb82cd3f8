"""Reads (read_id, header, seq, qual, barcode): filters, demultiplexing, statistics."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.batches import sliced, small_batches
from taxaflow.functions.ordering import row_number
from taxaflow.functions.sequence import count_char, error_chances, expected_errors, has_run, reverse_complement
from taxaflow.functions.staging import materialize
from taxaflow.operators.search import minimisers, seed_words, text_words


def truncate(reads: DataFrame, length: int) -> DataFrame:
    """Reads cut to ``length``; shorter ones are dropped."""
    out = reads.where(F.length("seq") >= length).withColumn("seq", F.substring("seq", 1, length))
    return out.withColumn("qual", F.substring("qual", 1, length)) if "qual" in reads.columns else out


def with_errors(reads: DataFrame) -> DataFrame:
    return reads.withColumn("ee", expected_errors(F.col("qual")))


def filter_errors(reads: DataFrame, max_ee: float = 1.0, discarded: bool = False) -> DataFrame:
    """Reads of at most ``max_ee`` expected errors (or the others), with ee."""
    fine = F.col("ee") <= max_ee
    return with_errors(reads).where(~fine if discarded else fine)


def filter_unknown(reads: DataFrame, most: int, base: str = "N") -> DataFrame:
    return reads.where(count_char(F.col("seq"), base) <= most)


def drop_runs(reads: DataFrame, length: int = 20) -> DataFrame:
    """Drops reads with a base ``length`` times in a row."""
    return reads.where(~has_run(F.col("seq"), length))


def bloom_filter(seqs: DataFrame, k: int, most_bytes: int = 64 << 20) -> np.ndarray | None:
    """Bits of the words of length k of all sequences (seq), 16 for each word and two set; None if they would take more than ``most_bytes``."""
    words = seqs.where(F.length("seq") >= k).agg(F.sum(F.length("seq") - k + 1)).first()[0] or 0
    size = 64 * max(1, -(-16 * words // 64))
    if size // 8 > most_bytes:
        return None
    hashed = seed_words(seqs.withColumn("_id", F.lit(0)), ["_id"], k, 1)
    bit = F.explode(F.array(F.pmod("word", F.lit(size)), F.pmod(F.xxhash64("word"), F.lit(size))))
    slots = hashed.select(bit.alias("_bit")).groupBy(F.expr("_bit div 64").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("bits")).collect()
    held = np.zeros(size // 64, np.int64)
    for r in slots:
        held[r["slot"]] = r["bits"]
    return held


def _may_match(reads: DataFrame, held: np.ndarray, k: int, least: int) -> DataFrame:
    """(read_id, seq, _words, _places): reads of which at least ``least`` words pass the filter, those words and where they begin (from 0)."""
    small_batches(reads.sparkSession)
    size = 64 * len(held)

    def run(batches):
        for b in sliced(batches, ["seq"]):
            rows, words, places = [], [], []
            for i, s in enumerate(b.column(1).to_pylist()):
                h, at = minimisers(s.encode("ascii", "replace") if s else b"", k, 1)
                first = h % size
                fits = held[first >> 6] >> (first & 63) & 1 == 1
                h, which = np.unique(h[fits], return_inverse=True)
                if len(h) < least:
                    continue
                second = np.fromiter((xxhash.xxh64_intdigest(int(x).to_bytes(8, "little", signed=True), 42) for x in h), np.uint64, len(h)).view(np.int64) % size
                good = held[second >> 6] >> (second & 63) & 1 == 1
                if good.sum() >= least:
                    rows.append(i)
                    places.append(at[fits][good[which]].tolist())
                    words.append([s[a : a + k] for a in places[-1]])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), b.column(1).take(pa.array(rows, pa.int64())), pa.array(words, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32()))], ["read_id", "seq", "_words", "_places"])

    return reads.select("read_id", "seq").mapInArrow(run, f"read_id {dict(reads.dtypes)['read_id']}, seq string, _words array<string>, _places array<int>")


def matching_reads(reads: DataFrame, reference: DataFrame, k: int = 24, least: int = 4, identity: float | None = None, overlap: int | None = None) -> DataFrame:
    """(read_id) of the reads that share ``least`` different words of length k with reference sequences (seq) or their reverse complements.

    With ``identity`` the read must also lie along one of them on a diagonal of such a word, without gaps, over
    ``overlap`` places (by default k) or more, with that share of equal letters. Reads pass a Bloom filter of the reference's words
    first, if that fits in memory; those that pass are written down, and only their words that pass too are joined.
    """
    both = reference.select("seq").unionByName(reference.select(reverse_complement(F.col("seq")).alias("seq"))).where("seq is not null").distinct()
    held = bloom_filter(both, k)
    words = text_words(both.withColumn("_id", F.lit(0)), ["_id"], k).select("word").distinct()
    if held is None:
        some = reads.select("read_id", "seq")
        own = text_words(some, ["read_id"], k, places=True)
    else:
        some = materialize(_may_match(reads, held, k, least), "reads-met")
        own = some.select("read_id", F.explode(F.arrays_zip(F.col("_words").alias("word"), F.col("_places").alias("place"))).alias("x")).select("read_id", "x.word", "x.place")
    found = own.join(words, "word", "left_semi").groupBy("read_id").agg(F.count_distinct("word").alias("n")).where(F.col("n") >= least).select("read_id")
    if identity is None:
        return found
    own = own.join(found, "read_id", "left_semi")
    some = some.select("read_id", "seq")
    theirs = text_words(both.withColumn("_ref", F.col("seq")), ["_ref"], k, places=True).withColumnRenamed("place", "_at")
    met = own.join(theirs, "word").withColumnRenamed("place", "_r")
    met = met.select("read_id", "_ref", (F.col("_at") - F.col("_r")).alias("_shift")).distinct().join(some, "read_id")
    # The read's place r lies on the reference's r + shift; both are cut to where they overlap.
    start, n = F.greatest(-F.col("_shift"), F.lit(0)), F.length("seq")
    span = F.least(n, F.length("_ref") - F.col("_shift")) - start
    met = met.select("read_id", F.substring("seq", start + 1, span).alias("_a"), F.substring("_ref", start + F.col("_shift") + 1, span).alias("_b"))
    met = met.where(F.length("_a") >= (overlap or k))

    def along(batches):
        for b in batches:
            a, c = (np.frombuffer("".join(x).encode("utf-32-le"), np.uint32) for x in (b.column(1).to_pylist(), b.column(2).to_pylist()))
            size = np.array([len(x) for x in b.column(1).to_pylist()], np.int64)
            upto = np.concatenate([[0], np.cumsum(a == c)])
            ends = size.cumsum()
            share = (upto[ends] - upto[ends - size]) / size
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(share >= identity - 1e-12))], ["read_id"])

    return met.mapInArrow(along, some.select("read_id").schema).distinct()


def drop_matching(reads: DataFrame, reference: DataFrame, k: int = 24, least: int = 4, identity: float | None = None, overlap: int | None = None) -> DataFrame:
    """Drops the reads that match a reference (see ``matching_reads``), as spike-ins are removed."""
    return reads.join(matching_reads(reads, reference, k, least, identity, overlap), "read_id", "left_anti")


def demultiplex(reads: DataFrame, sample_map: DataFrame) -> DataFrame:
    """Reads of known barcodes with their sample_id; the rest is dropped."""
    return reads.join(sample_map.select("barcode", "sample_id"), "barcode")


def unmatched(reads: DataFrame, sample_map: DataFrame) -> DataFrame:
    return reads.join(sample_map.select("barcode"), "barcode", "left_anti")


def count_by_sample(reads: DataFrame, sample_map: DataFrame) -> DataFrame:
    """(sample_id, barcode, read_count) for every sample of the map, 0 included."""
    counts = reads.groupBy("barcode").agg(F.count(F.lit(1)).alias("read_count"))
    return sample_map.select("sample_id", "barcode").join(counts, "barcode", "left").select("sample_id", "barcode", F.coalesce("read_count", F.lit(0)).alias("read_count"))


def barcode_counts(reads: DataFrame, first: int | None = None) -> DataFrame:
    """(barcode, n); ``first`` stops after so many reads."""
    return (reads.limit(first) if first else reads).groupBy("barcode").agg(F.count(F.lit(1)).alias("n"))


def error_statistics(reads: DataFrame, lengths: list[int], limits: tuple[float, ...] = (0.5, 1.0, 2.0)) -> DataFrame:
    """(length, n_reads, ee_<limit>...): reads that reach each length, and those within each error limit when cut to it.

    One pass: each read's running errors are looked up at every length, and tasks hand on their counts alone.
    """
    at = np.array(sorted(set(lengths)), np.int64)
    names = ["n_reads", *(f"ee_{str(x).replace('.', '_')}" for x in limits)]
    bounds = np.array([np.inf, *limits])

    def run(batches):
        total = np.zeros((len(at), len(bounds)), np.int64)
        for b in batches:
            for q in b.column(0).to_pylist():
                if q is not None:
                    reached = at[: np.searchsorted(at, len(q), "right")]
                    ee = np.concatenate([[0.0], np.cumsum(error_chances(q))])[reached]
                    total[: len(reached)] += ee[:, None] <= bounds
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *map(pa.array, total.T.copy())], ["length", *names])

    schema = "length int, " + ", ".join(f"{n} long" for n in names)
    sums = reads.select("qual").mapInArrow(run, schema).groupBy("length").agg(*[F.sum(n).alias(n) for n in names])
    return sums.where("n_reads > 0")


def base_frequencies(reads: DataFrame) -> DataFrame:
    """(base, n, share) over all reads; tasks count their reads' bases before they are summed."""

    def run(batches):
        plain, other = np.zeros(128, np.int64), Counter()
        for b in batches:
            for q in b.column(0).to_pylist():
                if q and q.isascii():
                    plain += np.bincount(np.frombuffer(q.encode(), np.uint8), minlength=128)
                elif q:
                    other.update(q)
        other.update({chr(i): int(n) for i, n in enumerate(plain) if n})
        yield pa.RecordBatch.from_arrays([pa.array(list(other), pa.string()), pa.array(list(other.values()), pa.int64())], ["base", "n"])

    per = reads.select("seq").mapInArrow(run, "base string, n long").groupBy("base").agg(F.sum("n").alias("n"))
    every = Window.partitionBy(F.lit(1))  # a row for each letter
    return per.select("base", "n", (F.col("n") / F.sum("n").over(every)).alias("share"))


def length_statistics(reads: DataFrame) -> DataFrame:
    n = F.length("seq")
    return reads.agg(F.count(F.lit(1)).alias("n_reads"), F.min(n).alias("min_len"), F.avg(n).alias("avg_len"), F.max(n).alias("max_len"))


def longest_of_first(reads: DataFrame, first: int = 100) -> DataFrame:
    """The longest of the first reads (by ord), from which the default statistics range ends 5 earlier."""
    return reads.orderBy("ord").limit(first).agg(F.max(F.length("seq")).alias("max_len"), (F.max(F.length("seq")) - 5).alias("last_len"))


def subset_by_group(reads: DataFrame, sample_map: DataFrame, group: str) -> DataFrame:
    """Reads (with sample_id) and the group of their sample; samples without group are left out."""
    return reads.join(sample_map.where(F.col(group).isNotNull()).select("sample_id", F.col(group).alias("group")), "sample_id")


def samples_of_groups(sample_map: DataFrame, group: str) -> DataFrame:
    g = sample_map.where(F.col(group).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_list("sample_id")).alias("s"))
    return g.select(F.col(group).alias("group"), F.array_join("s", ",").alias("samples"))


def to_fasta(reads: DataFrame, key: str = "read_id") -> DataFrame:
    """Records as text, one in each row."""
    return reads.select(F.concat(F.lit(">"), F.col(key), F.lit("\n"), F.col("seq")).alias("value"))


def only_ids(seqs: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The records whose id is listed."""
    return seqs.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi")


def sorted_ids(rows: DataFrame, key: str = "id") -> DataFrame:
    """(id, place): distinct ids in order, numbered from 1."""
    return row_number(rows.select(F.col(key).alias("id")).where("id is not null").distinct(), [F.col("id").asc()], "place")
