import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.llm import feistel, mixing, queries, sharding
from taxaflow.llm.common import row_hash
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    x = np.arange(n, dtype=np.uint64)
    y = feistel.permute(x, n, 42)
    assert sorted(y.tolist()) == list(range(n)) and (feistel.unpermute(y, n, 42) == x).all()
    assert n < 64 or (feistel.permute(x, n, 43) != y).any()


def test_feistel_refuses_values_outside():
    with pytest.raises(ValueError):
        feistel.permute([5], 5, 1)


def test_op2_law(spark):
    rows = queries.op2_shard(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r["size"] == len(docs[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in rows)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(16))
    for s in counts:
        assert sorted(r.slot for r in rows if r["shard"] == s) == list(range(counts[s]))
    again = queries.op2_shard(spark, SF).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)


def test_shards_of_odd_rows(spark):
    rows = [(None, None, "x"), (None, None, "x"), (3, "", None), (3, "a" * 100_000, "y"), (3, "a", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.shard_rows(df, 2, ["doc_id"])
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    assert sorted((r["shard"], r.slot) for r in got.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert sharding.shard_rows(df.where("false"), 2, ["doc_id"]).count() == 0

    assert sharding.shard_rows(df.repartition(5), 2, ["doc_id"]).count() == 5


def test_targets_are_shared_out():
    got = mixing.share_out([100, 100, 1000, 0], [5, 2, 1, 5], 1.5, 2)
    assert got[0] == 200 and got[1] == 200 and got[3] == 0 and abs(sum(got) - 1800) < 1e-9
    assert mixing.share_out([], [], 1.5, 2) == []


def test_draws_are_exact():
    drawn = list(mixing.draw_shards([700, 20, 0, 333], 64, 1))
    total, per = Counter(), Counter()
    for shard, i, first, n, before, size in drawn:
        assert first == total[i] and before == per[shard, size]
        total[i] += n
        per[shard, size] += n
    assert [total[i] for i in range(4)] == [700, 20, 0, 333]
    assert all(n == size for (_, size), n in per.items()) and sorted(s for s, _ in per) == list(range(17))
    assert [x for a, b in ((0, 5), (5, 6), (6, 17)) for x in mixing.draw_shards([700, 20, 0, 333], 64, 1, a, b)] == drawn
    assert list(mixing.draw_shards([0, 0], 64, 1)) == list(mixing.draw_shards([], 64, 1)) == []


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_mix_takes_its_targets(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{i}_{k}" for k in range(rng.integers(0, 90))) for i in range(120)] + [None, "", "  \n", "z " * 4000]
    docs = documents(spark, texts, ["b", "a", None, "c"])
    got = mixing.mix_sources(docs, block_words=16, blocks_per_shard=32).collect()
    assert len(got) == len(texts)
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sum(len(words(r.text)) for r in own)}
        assert sum(r.taken for r in own) == round(own[0].target)
    assert all(r["size"] == len(words(r.text)) and r.taken <= 2 * r["size"] and r.taken == sum(p.words for p in r.pieces or []) for r in got)
    places = Counter((p.shard, p.slot) for r in got for p in r.pieces or [])
    by_shard = {s: {x for y, x in places if y == s} for s, _ in places}
    assert all(x == set(range(len(x))) for x in by_shard.values())  # slots are gapless
    again = mixing.mix_sources(docs.repartition(7), block_words=16, blocks_per_shard=32).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_cut_texts_have_the_taken_words(spark):
    texts = [" ".join(f"w{i}_{k}" for k in range(40)) for i in range(30)]
    mixed = mixing.mix_sources(documents(spark, texts, ["a", "b"]), block_words=8, blocks_per_shard=16)
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    cut = mixing.cut_texts(mixed)
    assert cut.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    found = Counter()
    for r in cut.collect():
        found[r.doc_id] += len(words(r.text))
        assert set(words(r.text)) <= set(words(texts[r.doc_id])) and r.n_chars == len(r.text)
    assert found == Counter({k: v for k, v in taken.items() if v})


def test_mix_of_nothing_and_clashing_names(spark):
    docs = documents(spark, ["a b", "c"]).withColumn("size", F.lit("x"))
    assert dict(mixing.mix_sources(docs).dtypes)["size"] == "bigint"
    assert mixing.mix_sources(docs.where("false")).count() == 0
    assert mixing.mix_sources(documents(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0


def test_cut_texts_keep_other_columns(spark):
    big = 2**60 + 1
    rows = [(big, "a b c", "s", None, 5), (None, "d e", "s", [1, None], 3), (big + 2, None, None, None, None), (4, "", "s", [2], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tags array<long>, n_chars int")
    got = mixing.cut_texts(mixing.mix_sources(docs))
    assert got.schema == docs.schema
    assert {(r.doc_id, tuple(r.tags or ())) for r in got.collect()} <= {(big, ()), (None, (1, None))}
    assert sum(len(words(r.text)) for r in got.collect()) == 8  # 150 % of five words
    assert mixing.cut_texts(mixing.mix_sources(docs.where("false"))).count() == 0


def test_rows_with_nulls_in_other_places_differ(spark):
    rows = spark.createDataFrame([(1, "x", None), (1, None, "x"), (None, 1, "x")], "a string, b string, c string")
    assert rows.select(row_hash(rows).alias("h")).distinct().count() == 3


def test_op1_on_its_table(spark):
    rows = queries.op1_mix(spark, SF).collect()
    texts = {r.doc_id: (r.source, len(words(r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes = Counter()
    for s, n in texts.values():
        sizes[s] += n
    names = sorted((s for s in sizes if s is not None), key=lambda x: x.encode("utf-32-be")) + [None] * (None in sizes)
    left, unit, capped = 1.5 * sum(sizes.values()), 0.0, set()
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    for _ in names:
        unit = left / sum(weight[s] for s in names if s not in capped) if len(capped) < len(names) else 0
        above = {s for s in names if s not in capped and weight[s] * unit > 2 * sizes[s]}
        left, capped = left - sum(2 * sizes[s] for s in above), capped | above
    for r in rows:
        source, size = texts[r.doc_id]
        want = 2 * sizes[source] if source in capped else weight[source] * unit
        assert r["size"] == size and r.source_size == sizes[source] and abs(r.target - want) < 1e-6 * want and r.taken <= 2 * size
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
    assert len(rows) == len(texts) and all(abs(taken[r.source] - r.target) <= 0.5 for r in rows)


def test_op2_takes_null_and_empty_texts(spark, tmp_path):
    rows = [(1, None, "a"), (2, "", None), (None, "é" * 70_000, "b"), (None, "é" * 70_000, "b"), (3, "x", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r.doc_id or 0, r["size"], r.text_crc32) for r in queries.op2_shard(spark, str(tmp_path)).collect()))
    assert got == [(0, 140_001, zlib.crc32(("é" * 70_000).encode()))] * 2 + [(1, 1, 0), (2, 1, 0), (3, 2, zlib.crc32(b"x"))]
