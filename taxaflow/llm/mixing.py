"""Mixing sources to target weights with packed blocks."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import n_words, row_hash, sliced, small_batches, tidy
from .feistel import key_of, permute, unpermute


def share_out(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets in proportion to weight that sum to ``share`` times all sizes, none above ``most`` times its size."""
    targets, left, open_ = [0.0] * len(sizes), share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not above:
            for i in open_:
                targets[i] = weights[i] * unit
            break
        for i in above:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(above)]
    return targets


def _before(slot: int, short_at: int, block: int, short: int) -> int:
    """Words in the slots before ``slot`` of one pass over a source whose short block stands at ``short_at``."""
    return slot * block - (block - short if slot > short_at else 0)


def plan_source(index: int, size: int, target: float, block: int, seed: int) -> dict:
    """Slots of one source: whole passes, then a pass that stops at exactly the words still owed."""
    blocks, owed = -(-size // block), round(target)
    passes, rest = divmod(owed, size) if size else (0, 0)
    short = size - (blocks - 1) * block if blocks else 0
    plan = {"blocks": blocks, "passes": passes, "rest": rest, "short": short, "size": size}
    plan["keys"] = [key_of(seed, index, e) for e in range(passes + 1)]
    plan["short_at"], last = 0, 0
    if rest:
        plan["short_at"] = int(unpermute([blocks - 1], blocks, plan["keys"][passes])[0])
        last = max(0, rest // block - 1)
        while _before(last, plan["short_at"], block, short) < rest:
            last += 1
    plan["slots"] = passes * blocks + last
    return plan


def draw(slots: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``n`` slots each source gets: multinomial in proportion to what it owes, and never more than that."""
    counts = np.zeros(len(slots), np.int64)
    while (need := n - int(counts.sum())) > 0:
        free = slots - counts
        counts += np.minimum(rng.multinomial(need, free / free.sum()), free)
    return counts


def draw_shards(slots: list[int], per_shard: int, seed: int, start: int = 0, stop: int | None = None):
    """(shard, source, first slot of the source, count, slots in the shard before it, slots in the shard) of the output
    shards ``start`` to ``stop``: multinomial counts for each.

    Shards are the leaves of a binary tree of ranges. Each node's counts are split by a draw of its own, seeded by its
    range, so that a task that knows the totals draws its range alone, and the totals over all shards are exact.
    """
    total = sum(slots)
    last = -(-total // per_shard)
    todo = [(0, last, np.array(slots, np.int64), np.zeros(len(slots), np.int64))] if total else []
    while todo:
        low, high, owed, used = todo.pop()
        if high <= start or (stop is not None and low >= stop):
            continue
        if high - low > 1:
            mid = (low + high) // 2
            left = draw(owed, (mid - low) * per_shard, np.random.default_rng([seed, low, high]))
            todo += [(mid, high, owed - left, used + left), (low, mid, left, used)]
            continue
        before, size = 0, int(owed.sum())
        for i in np.flatnonzero(owed):
            yield low, int(i), int(used[i]), int(owed[i]), before, size
            before += int(owed[i])


def mix_sources(
    docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
    block_words: int = 256, blocks_per_shard: int = 4096, seed: int = 17, source: str = "source", text: str = "text",
    rows_per_bucket: int = 16_384,
) -> DataFrame:
    """Mixes sources to target weights; every input row comes back once, with what the mix takes of it.

    Each source's words (in a fixed row order) are one stream, cut into blocks of ``block_words``. Sources in code-point
    order, null last, weigh ``weights`` in turn and share ``share`` times all words, none above ``most`` times its own.
    Output shards draw multinomial counts of slots per source; slot j of a source is mapped through a keyed permutation
    of the source's block numbers (another one for each pass), and slots and blocks are joined by block number.

    Adds size, source_size (long), target (double), taken (long) and pieces, an array of (shard, slot, pass, start,
    words): ``words`` words from word ``start`` of the document stand in that slot. A source's taken words equal its
    rounded target, and no word is taken more than ``most`` times. Only totals reach the driver, one row for each source
    (sources are few enough to be given weights: each task holds their plans); what the shards draw is drawn in tasks.

    Null and empty texts have size 0 and take nothing; a null source is a source of its own; long documents span
    blocks; repeated rows and ties are separate rows (ones equal in all columns stand in one bucket); an empty table gives an empty result; other columns pass through,
    but input columns named like added ones are replaced.
    """
    added = ["size", "source_size", "target", "taken", "pieces"]
    docs = tidy(docs, [source, text], [*added, "_bucket", "_rid", "_pos", "_h", "_h2", "_s", "_block", "_n", "_off", "_named"])
    spark = docs.sparkSession
    rows = docs.withColumn("size", n_words(F.col(text))).withColumn("_h", row_hash(docs)).withColumn("_h2", row_hash(docs, 1))

    per_source = sorted(((r[0], r[1], r[2]) for r in rows.groupBy(source).agg(F.sum("size"), F.count(F.lit(1))).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [r[1] for r in per_source]
    targets = share_out(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    plans = [plan_source(i, s, t, block_words, seed) for i, (s, t) in enumerate(zip(sizes, targets))]
    named = spark.createDataFrame([(i, r[0], r[1], t) for i, (r, t) in enumerate(zip(per_source, targets))], f"_s int, `{source}` {dict(docs.dtypes)[source]}, source_size long, target double")

    # Place of each row in its source's stream: buckets of a source are summed alone, then shifted.
    buckets = max(64, -(-sum(r[2] for r in per_source) // rows_per_bucket))
    if len(per_source) <= 100_000:  # a broadcast of a few MB at most; beyond that Spark chooses
        named = F.broadcast(named)
    rows = rows.join(named.withColumnRenamed(source, "_named"), F.col(source).eqNullSafe(F.col("_named"))).drop("_named")
    rows = rows.withColumn("_bucket", F.pmod("_h", F.lit(buckets)).cast("int"))
    inside = Window.partitionBy("_s", "_bucket").orderBy("_h", "_h2")  # rows equal in both are equal, and as good as each other
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_n", F.coalesce(F.sum("size").over(upto), F.lit(0))).withColumn("_rid", F.struct("_s", "_bucket", F.row_number().over(inside).alias("i")))
    shifts = rows.groupBy("_s", "_bucket").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = shifts.select("_s", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    placed = placed.join(shifts, ["_s", "_bucket"]).withColumn("_pos", F.col("_off") + F.col("_n")).drop("_off", "_n")

    covered = (
        placed.where("size > 0").select("_rid", "_s", "_pos", "size")
        .withColumn("_block", F.explode(F.expr(f"sequence(_pos div {block_words}, (_pos + size - 1) div {block_words})")))
    )
    slots = slot_table(spark, plans, block_words, blocks_per_shard, seed)
    start = F.greatest(F.col("_block") * block_words, F.col("_pos"))
    stop = F.least(F.col("_block") * block_words + F.col("_len"), F.col("_pos") + F.col("size"))
    # Spark can't see the size of the slots, which grows with the words: they are never to be broadcast.
    pieces = covered.join(slots.hint("merge"), ["_s", "_block"]).withColumn("_words", stop - start).where("_words > 0")
    pieces = pieces.groupBy("_rid").agg(
        F.sort_array(F.collect_list(F.struct("pass", (start - F.col("_pos")).alias("start"), "shard", "slot", F.col("_words").alias("words")))).alias("pieces"),
        F.sum("_words").alias("taken"),
    )
    out = placed.join(pieces, "_rid", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *added)


def slot_table(spark, plans: list[dict], block_words: int, blocks_per_shard: int, seed: int) -> DataFrame:
    """One row for each slot of the mix: source ``_s``, ``_block``, words used of it ``_len``, pass, shard, slot."""
    totals = [p["slots"] for p in plans]
    shards = -(-sum(totals) // blocks_per_shard)

    def drawn_range(batches):
        for b in batches:
            ids = b["id"].to_numpy(np.int64)
            for part in np.split(ids, np.flatnonzero(np.diff(ids) != 1) + 1) if len(ids) else []:
                yield pd.DataFrame(draw_shards(totals, blocks_per_shard, seed, int(part[0]), int(part[-1]) + 1), columns=["shard", "_s", "first", "n", "base", "size"])

    drawn = spark.range(0, shards, 1, max(1, min(shards, 1000))).mapInPandas(drawn_range, "shard int, _s int, first long, n long, base long, size long")
    each = drawn.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    each = each.select("shard", "_s", (F.col("first") + F.col("i")).alias("j"), (F.col("base") + F.col("i")).alias("at"), "size")

    def place(batches):
        for b in batches:
            s, j = b["_s"].to_numpy(), b["j"].to_numpy(np.int64)
            block, used, turn = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for i in np.unique(s):
                p, m = plans[i], s == i
                e, k = np.divmod(j[m], p["blocks"])
                block[m] = x = permute(k, p["blocks"], np.array(p["keys"], np.uint64)[e]).astype(np.int64)
                full = np.where(x == p["blocks"] - 1, p["short"], block_words)
                owed = p["rest"] - (k * block_words - np.where(k > p["short_at"], block_words - p["short"], 0))
                used[m], turn[m] = np.where(e < p["passes"], full, np.minimum(full, owed)), e
            keys = np.array([key_of(seed, 1 << 40, int(x)) for x in b["shard"].unique()], np.uint64)
            keys = pd.Series(keys, index=b["shard"].unique()).loc[b["shard"]].to_numpy(np.uint64)
            slot = permute(b["at"].to_numpy(np.uint64), b["size"].to_numpy(np.uint64), keys).astype(np.int64)
            yield pd.DataFrame({"_s": s, "_block": block, "_len": used, "pass": turn, "shard": b["shard"], "slot": slot})

    return each.mapInPandas(place, "_s int, _block long, _len long, pass int, shard int, slot long")


def cut_texts(mixed: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The mixed documents: a row for each document and pass that takes words of it, its text cut to the words taken.

    A pass that takes the whole document keeps the text as it is; otherwise the taken stretches of the text, from the
    start of their first word to the end of their last, are joined by a line break. ``n_chars``, if there is such a
    column, becomes the new text's length; all other columns, null or not, are copied as they are.

    Documents of which nothing is taken (so null texts and ones without words) have no row; long texts are cut whole;
    repeated rows are cut each by its own pieces; an empty table gives an empty result.
    """
    schema = mixed.drop("size", "source_size", "target", "taken", "pieces").schema
    word = re.compile(r"[^\x20\x09-\x0D]+")
    small_batches(mixed.sparkSession)

    def passes(whole: str, size: int, pieces: list[dict]):
        spans = None
        for turn in sorted({p["pass"] for p in pieces}):
            runs: list[list[int]] = []
            for p in (p for p in pieces if p["pass"] == turn):  # ordered by start
                if runs and runs[-1][1] == p["start"]:
                    runs[-1][1] += p["words"]
                else:
                    runs.append([p["start"], p["start"] + p["words"]])
            if runs == [[0, size]]:
                yield whole
            else:
                spans = spans or [m.span() for m in word.finditer(whole)]
                yield "\n".join(whole[spans[x][0] : spans[y - 1][1]] for x, y in runs)

    def cut(batches):
        for b in sliced(batches, [text]):
            rows, texts = [], []
            for i, x in enumerate(zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in (text, "size", "pieces")))):
                for kept in passes(*x) if x[2] else ():
                    rows.append(i)
                    texts.append(kept)
            at, columns = pa.array(rows, pa.int64()), []
            for f in schema:
                if f.name == text:
                    columns.append(pa.array(texts, pa.string()))
                elif f.name == n_chars:
                    columns.append(pa.array(list(map(len, texts)), pa.int64()).cast(to_arrow_type(f.dataType)))
                else:
                    columns.append(b.column(b.schema.get_field_index(f.name)).take(at))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return mixed.drop("source_size", "target", "taken").mapInArrow(cut, schema)
