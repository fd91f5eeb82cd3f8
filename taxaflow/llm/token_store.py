"""Token ids of documents as raw binary shards, with keyed access through minimal perfect hashes.

A store is a folder on any file system that Arrow can open (local, HDFS, S3, GCS):

* ``ids-<shard>-<attempt>.bin``: the ids of one document after the other, each ``width`` bytes, little-endian; then for
  each document the number of ids up to its end (uint64); then the number of documents and the width (uint64 each).
  Documents stand in ascending order of key over the shards; a file can be mapped into memory as it is.
* ``index-<bucket>-<attempt>.npz``: the keys of one range of hashes: a minimal perfect hash, and for each slot a fingerprint
  and the spans (shard, first document, number of documents) that have the key.
* ``shards``, ``buckets``, ``unkeyed``: tables of these files and of the documents without key. Only what these tables
  name belongs to the store: files of attempts that were lost or repeated are never read.
"""

from __future__ import annotations

import io
import json
import os
import struct
import uuid
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import materialize, sliced, small_batches, tidy
from .perfect_hash import PerfectHash
from .tables import gathered

FINGERPRINT = np.uint64(32)
#: Fixed number that tells the second hash of a key from the first.
SECOND = 11
#: White space other than a space, before one.
SPACE_RUN = "[\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] "
#: Marks that words often end with; words of letters of the first blocks of Unicode, and what marks they have at their end.
MARKS = ".,;:!?)"
LETTERS_ONLY, MARKS_AT_END = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$", r"(?s)^.*?([.,;:!?)]*)$"
#: Letters below this are letters to every version of Unicode.
OLD_LETTERS = "\u0250"
#: The characters that stand for bytes in byte-level models: printable ones of Latin-1 for themselves, others from U+0100 on in order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


class UnitEncoder:
    """Ids of texts by the tokenizers library, as bytes.

    Byte-level tokenizers of the usual pattern never join a character that isn't white space with a space after it, so texts are cut
    there; the ids of cut-off units are kept for the life of a worker (up to ``most`` of them, then anew), and the library
    encodes each only once. Words are told apart in Arrow columns, so that Python sees each once in a batch. Other tokenizers get whole texts.
    """

    def __init__(self, path: str, most: int = 800_000, longest: int = 64):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        bytewise = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        # Added tokens that reach over spaces, or take in those beside them, would span cuts; ones of letters could stand in words.
        added = any(" " in t["content"] or t["content"].isalpha() or t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in spec.get("added_tokens", []))
        self.by_units = bytewise and not spec.get("normalizer") and not spec.get("truncation") and not added and model.get("type") == "BPE" and not model.get("dropout")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype, self.kind = np.dtype(f"<u{self.width}"), "H" if self.width == 2 else "I"
        self.most, self.longest, self.known, self._long = most, longest, {}, []

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _known(self, keys: list[str]) -> list[bytes]:
        """Ids of units; new ones are learnt. Letters, and a space before them or none, are one piece, which the library's
        model takes without further ado."""
        new = [u for u in dict.fromkeys(keys) if u not in self.known]
        kind, tokenize = self.kind, self.tokenizer.model.tokenize
        words = [u for u in new if u[u[:1] == " " :].isalpha() and max(u) < OLD_LETTERS]
        self.known.update((u, array(kind, [t.id for t in tokenize(bytewise(u))]).tobytes()) for u in words)
        rest = [u for u in new if u not in self.known] if len(words) < len(new) else []
        self.known.update(zip(rest, self._raw(rest)))
        self._long += [u for u in new if len(u) > self.longest]
        return list(map(self.known.__getitem__, keys))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts laid end to end, each with ``end_id`` after it; how many each text has)."""
        end = np.array([end_id], self.dtype).tobytes()
        if not self.by_units:
            raw = self._raw(texts.to_pylist())
            return np.frombuffer(b"".join(r + end for r in raw), self.dtype), np.fromiter(map(len, raw), np.int64, len(raw)) // self.width + 1
        if len(self.known) > self.most:
            self.known.clear()
        odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.match_substring_regex(texts, SPACE_RUN))
        words = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        flat, starts = words.flatten().dictionary_encode(), words.offsets.to_numpy()
        code, first, last = flat.indices.to_numpy(), starts[:-1], starts[1:]
        # Marks after letters begin a piece of their own, so words are learnt without them.
        word = flat.dictionary
        bare = pc.utf8_rtrim(word, MARKS)
        lettered = pc.match_substring_regex(bare, LETTERS_ONLY)
        bare = pc.if_else(lettered, bare, word)
        marked = np.flatnonzero(pc.not_equal(pc.binary_length(bare), pc.binary_length(word)).to_numpy(zero_copy_only=False))
        marks = pc.replace_substring_regex(word.take(pa.array(marked)), MARKS_AT_END, r"\1").dictionary_encode()
        bare = bare.dictionary_encode()
        held = self._known([" " + w for w in bare.dictionary.to_pylist()])
        after = [b"", *self._known(marks.dictionary.to_pylist())]
        tail = np.zeros(len(word), np.int64)
        tail[marked] = marks.indices.to_numpy() + 1
        openings = self._known(word.take(pa.array(code[first])).to_pylist())
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        for i, t in zip(whole, texts.take(pa.array(whole)).to_pylist()):
            openings[i] = b"".join(self._known(units(t)))
        # Entries: words after a space, no and other marks, the texts' first words or whole texts of other white space, and the end.
        entries = [*held, *after, *openings, end]
        two = np.empty(2 * len(code), np.int64)
        two[0::2], two[1::2] = bare.indices.to_numpy()[code], len(held) + tail[code]
        two[2 * first], two[2 * first + 1] = len(held) + len(after) + np.arange(len(texts)), len(held)
        two = np.insert(two, 2 * last, len(entries) - 1)
        count = np.fromiter(map(len, entries), np.int64, len(entries)) // self.width
        ids = gathered(np.frombuffer(b"".join(entries), self.dtype), count, two)
        upto = np.concatenate([[0], np.cumsum(count[two])])
        bounds = np.concatenate([[0], 2 * last + np.arange(1, len(texts) + 1)])
        for u in self._long:
            self.known.pop(u, None)
        self._long.clear()
        return ids, np.diff(upto[bounds])


def bytewise(unit: str) -> str:
    """Letters, with a space before them or none, as byte-level models write them."""
    if unit.isascii():
        return BYTE_CHARS[32] + unit[1:] if unit[0] == " " else unit
    return unit.encode().decode("latin-1").translate(BYTE_CHARS)


def units(text: str) -> list[str]:
    """The text cut before each space that follows a character other than white space."""
    first, *rest = text.split(" ")
    out = [first] if first else []
    for w in rest:
        if out and not out[-1][-1:].isspace():
            out.append(" " + w)
        elif out:
            out[-1] += " " + w
        else:
            out.append(" " + w)
    return out


@lru_cache(maxsize=2)
def encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _hashes(key: str) -> tuple[Column, Column]:
    return F.xxhash64(F.col(key)), F.xxhash64(F.lit(SECOND), F.col(key))


def key_hashes(key: int | str) -> tuple[int, int]:
    """The same two hashes outside Spark, of a long or a string."""
    raw = struct.pack("<q", key) if isinstance(key, int) else key.encode()
    return xxhash.xxh64_intdigest(raw, 42), xxhash.xxh64_intdigest(raw, xxhash.xxh64_intdigest(struct.pack("<i", SECOND), 42))


def _as_uint(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def write_store(docs: DataFrame, path: str, tokenizer: str, *, key: str = "doc_id", text: str = "text", end_id: int = 0, shard_bytes: int = 64 << 20, bucket_keys: int = 65_536) -> None:
    """Encodes whole texts and writes them as a store in the new folder ``path``.

    ``key`` is a long or a string; documents go in ascending order of it, nulls first, those of one key in the order of a hash of their text
    (equal rows as they come). A shard has some ``shard_bytes`` of text and a file of its own; one key or one text on many
    rows is spread over shards like others. A null text is an empty one, and every document ends with ``end_id``. The
    index is written for ranges of hashes of some ``bucket_keys`` keys. An empty table gives a store without files; other
    columns are left out.
    """
    spark, whole = docs.sparkSession, F.coalesce(F.col(text).cast("string"), F.lit(""))
    small_batches(spark)
    docs = tidy(docs, [key, text]).select(F.col(key).alias("key"), whole.alias("text"))
    size = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    order = ["key", "_h", "_row"]
    rows = docs.withColumn("_h", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(-(-size // shard_bytes) or 1, *order).sortWithinPartitions(*order)
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("slot", T.LongType()), docs.schema["key"], T.StructField("n_ids", T.LongType())])
    arrow = to_arrow_schema(schema)

    def write(batches):
        shard, enc, at, ends = TaskContext.get().partitionId(), None, 0, [np.zeros(1, np.int64)]
        name = f"ids-{shard:06}-{uuid.uuid4().hex}.bin"
        out = None
        for b in sliced(batches, ["text"], 1024, 4 << 20):
            if out is None:
                enc = encoder(tokenizer)
                fs, folder = _open(path)
                fs.create_dir(folder)
                out = fs.open_output_stream(f"{folder}/{name}")
            ids, n = enc.encode(b.column(b.schema.get_field_index("text")), end_id)
            out.write(ids.tobytes())
            ends.append(ends[-1][-1] + n.cumsum())
            slots = np.arange(at, at + len(n))
            at += len(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), shard, np.int32)), pa.array([name] * len(n)), pa.array(slots), b.column(b.schema.get_field_index("key")), pa.array(n)], schema=arrow)
        if out is not None:
            out.write(np.concatenate(ends)[1:].astype("<u8").tobytes() + struct.pack("<QQ", at, enc.width))
            out.close()

    placed = materialize(rows.select("key", "text").mapInArrow(write, schema), "placed")
    shards = placed.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    sums = [F.coalesce(F.sum(n).over(before), F.lit(0)).alias(a) for n, a in (("n_docs", "first_doc"), ("n_ids", "first_id"))]
    shards.select("*", *sums).write.parquet(f"{path}/shards")
    spans = placed.groupBy("key", "shard").agg(F.min("slot").alias("slot"), F.count(F.lit(1)).alias("n"))
    spans.where("key is null").select("shard", "slot", "n").write.parquet(f"{path}/unkeyed")
    n_keys = placed.agg(F.approx_count_distinct("key")).first()[0]
    _write_index(spans.where("key is not null"), path, max(64, -(-n_keys // bucket_keys)))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("_h1"), F.lit(buckets)).cast("int")


def _write_index(spans: DataFrame, path: str, buckets: int) -> None:
    h1, h2 = _hashes("key")
    hashed = spans.select(h1.alias("_h1"), h2.alias("_h2"), "shard", "slot", "n").withColumn("bucket", _bucket(buckets))

    def build(table: pa.Table) -> pa.Table:
        h1, h2 = (_as_uint(table[c].combine_chunks()) for c in ("_h1", "_h2"))
        shard, slot, n = (table[c].to_numpy() for c in ("shard", "slot", "n"))
        keys, where = np.unique(np.stack([h1, h2], 1), axis=0, return_inverse=True)
        found = PerfectHash.build(keys[:, 0], keys[:, 1])
        place = found.slots(keys[:, 0], keys[:, 1])
        own = place[where.ravel()]
        by = np.lexsort((shard, own))
        if len(np.unique(np.stack([own, shard], 1), axis=0)) < len(own):
            raise ValueError("two keys have the same hashes")
        marks = np.zeros(len(keys), np.uint32)
        marks[place] = (keys[:, 1] >> FINGERPRINT).astype(np.uint32)
        held = io.BytesIO()
        np.savez(held, bits=found.bits, sizes=found.sizes, marks=marks, first=np.concatenate([[0], np.bincount(own, minlength=len(keys)).cumsum()]), shard=shard[by].astype(np.int32), slot=slot[by], n=n[by])
        bucket = int(table["bucket"][0].as_py())
        name = f"index-{bucket:06}-{uuid.uuid4().hex}.npz"
        fs, folder = _open(path)
        fs.create_dir(folder)
        with fs.open_output_stream(f"{folder}/{name}") as out:
            out.write(held.getvalue())
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "index": [name], "n_keys": pa.array([len(keys)], pa.int64()), "buckets": pa.array([buckets], pa.int32())})

    hashed.groupBy("bucket").applyInArrow(build, "bucket int, index string, n_keys long, buckets int").write.parquet(f"{path}/buckets")


class Bucket:
    """One file of the index."""

    def __init__(self, path: str, name: str):
        fs, folder = _open(path)
        with fs.open_input_file(f"{folder}/{name}") as f:
            held = np.load(io.BytesIO(f.read()))
        self.hash = PerfectHash(held["bits"], held["sizes"])
        self.marks, self.first, self.shard, self.slot, self.n = (held[c] for c in ("marks", "first", "shard", "slot", "n"))

    def spans(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
        """(which key, shard, slot, n) of all spans; a key that isn't in the store has none, but for one in 2^32 of them."""
        place = self.hash.slots(h1, h2)
        known = np.flatnonzero(place >= 0)
        known = known[self.marks[place[known]] == (h2[known] >> FINGERPRINT).astype(np.uint32)]
        a, count = self.first[place[known]], self.first[place[known] + 1] - self.first[place[known]]
        at = np.repeat(a - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return np.repeat(known, count), self.shard[at], self.slot[at], self.n[at]


class Shard:
    """One file of ids."""

    def __init__(self, path: str, name: str):
        fs, folder = _open(path)
        self.file, self.name = fs.open_input_file(f"{folder}/{name}"), name
        size = self.file.size()
        n, self.width = struct.unpack("<QQ", self.file.read_at(16, size - 16))
        self.ends = np.frombuffer(self.file.read_at(8 * n, size - 16 - 8 * n), "<u8").astype(np.int64)

    def documents(self, slot: int, n: int, most: int = 4 << 20):
        """(first id's number in the shard, ids) of documents from ``slot`` on; neighbours are read together, ``most`` bytes or one
        document at a time."""
        stop = slot + n
        while slot < stop:
            a = int(self.ends[slot - 1]) if slot else 0
            to = max(slot + 1, min(stop, int(np.searchsorted(self.ends, a + most // self.width, "right"))))
            ids = np.frombuffer(self.file.read_at((int(self.ends[to - 1]) - a) * self.width, a * self.width), f"<u{self.width}")
            for end in self.ends[slot:to]:
                first, ids = ids[: int(end) - a], ids[int(end) - a :]
                yield a, first
                a = int(end)
            slot = to


def fetch(spark: SparkSession, path: str, keys: DataFrame, *, key: str = "doc_id", unkeyed: bool = False, binary: bool = False) -> DataFrame:
    """(key, doc, start, n_tokens, ids) of all documents in the store with one of these keys, read from its files.

    ``doc`` is the document's number and ``start`` the number of ids before it in the store. Keys are looked up in the
    index of their hashes; spans are then read shard by shard. Repeated and null keys in ``keys`` count once and not at
    all; ``unkeyed`` adds the documents without key. ``binary`` gives ids as little-endian unsigned 32-bit integers
    instead of an array. Keys that aren't in the store give no row.
    """
    small_batches(spark)
    shards, index, lone = (spark.read.parquet(f"{path}/{t}") for t in ("shards", "buckets", "unkeyed"))
    head = index.select("buckets").first()
    wanted = tidy(keys, [key]).select(F.col(key).alias("key")).where("key is not null").distinct()
    h1, h2 = _hashes("key")
    hashed = wanted.withColumn("_h1", h1).withColumn("_h2", h2).withColumn("bucket", _bucket(head[0] if head else 1))
    kind = wanted.schema["key"]
    spans_schema = T.StructType([kind, *T._parse_datatype_string("shard int, slot long, n long").fields])

    def look(table: pa.Table) -> pa.Table:
        which, *rest = Bucket(path, table["index"][0].as_py()).spans(*(_as_uint(table[c].combine_chunks()) for c in ("_h1", "_h2")))
        return pa.table([table["key"].take(pa.array(which)), *map(pa.array, rest)], schema=to_arrow_schema(spans_schema))

    spans = hashed.join(index.select("bucket", "index"), "bucket").groupBy("bucket").applyInArrow(look, spans_schema)
    if unkeyed:
        spans = spans.unionByName(lone.withColumn("key", F.lit(None).cast(kind.dataType)))
    ids = T.StructField("ids", T.BinaryType() if binary else T.ArrayType(T.IntegerType()))
    schema = T.StructType([T.StructField(key, kind.dataType), *T._parse_datatype_string("doc long, start long, n_tokens long").fields, ids])
    arrow = to_arrow_schema(schema)

    def read(batches):
        shard, held, size = None, [], 0
        for b in batches:
            for k, file, first_doc, first_id, slot, n in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("key", "file", "first_doc", "first_id", "slot", "n"))):
                if shard is None or shard.name != file:
                    shard = Shard(path, file)
                for i, (at, one) in enumerate(shard.documents(slot, n), first_doc + slot):
                    held.append((k, i, first_id + at, len(one), one.astype("<u4").tobytes() if binary else one.astype(np.int32)))
                    size += 4 * len(one)
                    if size > 2 << 20 or len(held) == 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    placed = spans.join(shards.select("shard", "file", "first_doc", "first_id"), "shard")
    # By number, so that partitions of few rows, which stand for many ids, aren't put together.
    return placed.repartition(max(1, shards.count()), "shard").sortWithinPartitions("shard", "slot").mapInArrow(read, schema)


class TokenStore:
    """A store read by one process, such as a trainer's loader: constant-time access by key, without Spark."""

    def __init__(self, path: str):
        fs, folder = _open(path)
        table = lambda t: ds.dataset(f"{folder}/{t}", filesystem=fs, format="parquet").to_table()
        shards, buckets = table("shards"), table("buckets")
        self.path, self.files = path, dict(zip(shards["shard"].to_pylist(), shards["file"].to_pylist()))
        self.index, self.buckets = dict(zip(buckets["bucket"].to_pylist(), buckets["index"].to_pylist())), (buckets["buckets"].to_pylist() or [1])[0]
        self.bucket, self.shard = lru_cache(64)(lambda i: Bucket(path, self.index[i])), lru_cache(64)(lambda i: Shard(path, self.files[i]))

    def get(self, key: int | str) -> list[np.ndarray]:
        """The ids of each document with that key."""
        h1, h2 = key_hashes(key)
        i = (h1 if h1 < 1 << 63 else h1 - (1 << 64)) % self.buckets
        if i not in self.index:
            return []
        _, shard, slot, n = self.bucket(i).spans(np.array([h1], np.uint64), np.array([h2], np.uint64))
        return [ids for s, a, k in zip(shard, slot, n) for _, ids in self.shard(int(s)).documents(int(a), int(k))]
