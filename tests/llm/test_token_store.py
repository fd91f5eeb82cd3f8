import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from taxaflow.llm import queries, token_store
from taxaflow.llm.perfect_hash import PerfectHash
from tests.llm.helpers import DOC

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def library(path=BPE):
    t = Tokenizer.from_file(path)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def plain(rows, encode):
    """What the query returns for (doc_id, text) rows of distinct keys, nulls first."""
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = encode(text)
        out.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def ids_of(enc, texts):
    ids, n = enc.encode(pa.array(texts, pa.string()), 0)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []


def whole_ids(enc, texts):
    return [[*e.ids, 0] for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def found(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def test_query_equals_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(queries.op11_ids(spark, SF)) == plain(rows, library())


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h1, h2 = (rng.integers(0, 2**64, n, np.uint64, endpoint=False) for _ in range(2))
    h1[: n // 2] = h1[n // 2 : n // 2 * 2]  # half of a pair may be equal
    made = PerfectHash.build(h1, h2)
    assert sorted(made.slots(h1, h2)) == list(range(n)) and made.n == n
    assert 8 * len(made.bits) <= 5 * n + 40 * 512
    with pytest.raises(ValueError):
        PerfectHash.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_units_join_to_the_library_ids():
    rng = np.random.default_rng(1)
    parts = ["a", "b ", "  ", "\n", " ", "　x", "\x1c", "don't", "..", "\t", "é", "日本", "<|endoftext|>", "x ", "12", "end.", "(a)", "́,", "a" * 70]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(3000)] + [" ".join(rng.choice(parts, 30)) for _ in range(1000)]
    enc = token_store.UnitEncoder(BPE, most=50)
    assert enc.by_units and enc.width == 2
    assert [x for i in range(0, len(texts), 100) for x in ids_of(enc, texts[i : i + 100])] == whole_ids(enc, texts)
    assert max(map(len, enc.known)) <= enc.longest


def test_words_and_marks_are_learnt_apart():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcXYZéüßñøŁſ×÷ªº.,;!?)('s ") for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    enc = token_store.UnitEncoder(BPE)
    assert ids_of(enc, texts) == whole_ids(enc, texts)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    enc, encode = token_store.UnitEncoder(path), library(path)
    assert not enc.by_units and ids_of(enc, ["Two  words", ""]) == [encode("Two  words"), [0]]


def test_odd_rows_and_access_by_key(spark, tmp_path):
    text = "some words, of a text"
    rows = [(5, text, "en", "a", 1)] * 3000 + [(None, "no key", "en", "a", 1), (None, None, None, None, None), (-7, "", "en", "a", 0), (2**62, "w " * 200_000, "en", "a", 9), (9, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOC).repartition(7).select("*", F.lit("x").alias("_h"), F.lit(1).alias("Text"), F.lit(2).alias("slot"))
    path, encode = str(tmp_path / "store"), library()
    token_store.write_store(docs, path, BPE, shard_bytes=20_000)
    got = token_store.fetch(spark, path, docs.select("doc_id", F.lit(1).alias("DOC_ID")), unkeyed=True).orderBy("doc").collect()
    assert [r.doc for r in got] == list(range(len(rows))) and [r.doc_id for r in got[:4]] == [None, None, -7, 5]
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])
    want = {r[0]: encode(r[1]) for r in rows[2:]}
    assert all(r.ids == (want[r.doc_id] if r.doc_id is not None else r.ids) for r in got) and sorted(len(r.ids) for r in got[:2]) == [1, len(encode("no key"))]
    assert spark.read.parquet(f"{path}/shards").count() > 3
    store = token_store.TokenStore(path)
    assert [list(x) for x in store.get(5)] == [want[5]] * 3000 and [list(x) for x in store.get(-7)] == [[0]] and store.get(6) == []
    assert [len(x) for x in store.get(2**62)] == [len(want[2**62])]
    some = token_store.fetch(spark, path, spark.createDataFrame([(9,), (None,), (10,), (9,)], "doc_id long"), binary=True).collect()
    assert [(r.doc_id, bytes(r.ids)) for r in some] == [(9, b"\0\0\0\0")]


def test_string_keys_and_lost_attempts(spark, tmp_path):
    docs = spark.createDataFrame([(f"k{i}", f"text {i}") for i in range(300)] + [("é", "accent")], "doc_id string, text string")
    path, encode = str(tmp_path / "store"), library()
    token_store.write_store(docs, path, BPE, shard_bytes=1000)
    (tmp_path / "store" / "ids-000000-lost.bin").write_bytes(b"half a file")
    got = {r.doc_id: list(r.ids) for r in token_store.fetch(spark, path, docs).collect()}
    assert got == {r.doc_id: encode(r.text) for r in docs.collect()}
    store = token_store.TokenStore(path)
    assert list(store.get("é")[0]) == encode("accent") and list(store.get("k7")[0]) == encode("text 7") and store.get("k300") == []


def test_empty_table(spark, tmp_path):
    docs, path = spark.createDataFrame([], DOC), str(tmp_path / "store")
    token_store.write_store(docs, path, BPE)
    assert token_store.fetch(spark, path, docs, unkeyed=True).count() == 0 and token_store.TokenStore(path).get(1) == []
