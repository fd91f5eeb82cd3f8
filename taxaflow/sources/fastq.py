"""FASTQ as a Spark data source: files of any store are read in ranges that start at records, blocked gzip as well."""

from __future__ import annotations

import fnmatch
import os
import struct
import zlib
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from taxaflow.sources.text import numbered_lines

SCHEMA = "read_id string, header string, seq string, qual string, barcode string, ord long"

#: How a block of blocked gzip begins (magic, deflate, extra field), and its subfield with the block's length.
GZIP, SUBFIELD = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
#: The longest block, and what is read at a time.
BLOCK, CHUNK = 1 << 16, 1 << 20


class Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int, kind: str):
        super().__init__((path, start, stop, kind))
        self.path, self.start, self.stop, self.kind = path, start, stop, kind


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), os.path.abspath(path))


def list_files(path: str) -> list[tuple[str, int]]:
    """(path or URI, size) of a file, of the files of a folder but hidden ones, or of those that a pattern in the last part names."""
    fs, inside = open_store(path)
    folder, name = inside.rsplit("/", 1)
    prefix = path[: len(path) - len(inside)] if path.endswith(inside) else ""
    if any(c in name for c in "*?["):
        found = [f for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if f.is_file and fnmatch.fnmatchcase(f.base_name, name)]
    else:
        one = fs.get_file_info(inside)
        if one.type == pafs.FileType.Directory:
            found = [f for f in fs.get_file_info(pafs.FileSelector(inside)) if f.is_file and f.base_name[0] not in "._"]
        elif one.is_file:
            found = [one]
        else:
            raise FileNotFoundError(path)
    return sorted((prefix + f.path, f.size) for f in found)


def block_size(head: bytes) -> int:
    """The length of the block of blocked gzip that begins here; 0 if none does."""
    if len(head) < 18 or not head.startswith(GZIP):
        return 0
    extra, at = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 4 <= len(extra):
        if extra[at : at + 4] == SUBFIELD and at + 6 <= len(extra):
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + struct.unpack_from("<H", extra, at + 2)[0]
    return 0


def first_block(f, start: int, size: int) -> int:
    """The place of the first block at or after ``start``: what looks like one and is followed by another, or by the end."""
    if not start:
        return 0
    held = f.read_at(min(2 * BLOCK + 64, size - start), start)
    at = held.find(GZIP)
    while at >= 0:
        n = block_size(held[at : at + 512])
        if n and (start + at + n == size or block_size(f.read_at(min(512, size - start - at - n), start + at + n))):
            return start + at
        at = held.find(GZIP, at + 1)
    return size


def plain_chunks(f, start: int, stop: int, size: int) -> Iterator[tuple[bytes, int, bool]]:
    """(data, place, own) from ``start`` to the file's end; what begins before ``stop`` is the range's own."""
    while start < size:
        n = min(CHUNK, (stop if start < stop else size) - start)
        yield f.read_at(n, start), start, start < stop
        start += n


def block_chunks(f, start: int, stop: int, size: int) -> Iterator[tuple[bytes, int, bool]]:
    """The same of blocked gzip: a block at a time, its place a virtual one (place of the block * 2^16)."""
    at = first_block(f, start, size)
    while at < size:
        raw = f.read_at(BLOCK, at)
        n = block_size(raw)
        if not n:
            raise ValueError(f"no block of gzip at {at}")
        # The header's extra field comes before the data; the checksum and length after it.
        data = zlib.decompress(raw[:n], 31)
        if data:
            yield data, at << 16, at < stop
        at += n


def gzip_chunks(f, start: int, stop: int, size: int) -> Iterator[tuple[bytes, int, bool]]:
    """The same of any gzip file, which is one range; places are those in the unpacked data."""
    unpack, at, place = zlib.decompressobj(31), 0, 0
    while at < size:
        raw = f.read_at(min(CHUNK, size - at), at)
        at += len(raw)
        while raw:
            data = unpack.decompress(raw)
            if data:
                yield data, place, True
                place += len(data)
            raw, unpack = (unpack.unused_data.lstrip(b"\0"), zlib.decompressobj(31)) if unpack.eof else (b"", unpack)


KINDS = {"plain": plain_chunks, "blocks": block_chunks, "gzip": gzip_chunks}


def lines_of(chunks) -> Iterator[tuple[bytes, int, bool]]:
    """(line, place, own): own if it begins in the range's own data or right after it."""
    rest, where, mine, inside = b"", 0, True, True
    for data, place, own in chunks:
        at, after, inside = 0, inside and not own, own
        while at < len(data):
            if not rest:
                where, mine = place + at, own or (after and at == 0)
            end = data.find(b"\n", at)
            if end < 0:
                rest += data[at:]
                break
            yield rest + data[at:end], where, mine
            rest, at = b"", end + 1
    if rest:
        yield rest, where, mine


def records(chunks, first: bool) -> Iterator[tuple[str, str, str, int]]:
    """(header, seq, qual, place) of the records of a range.

    A range other than the file's first leaves out the line that it begins in or with, and starts at the first record after it: a line with @
    whose next but one begins with + (a quality line may begin with @ too; then its next but one is a sequence). The
    range before has the records that begin in its own data or right after it, and reads on to their ends.
    """
    lines = lines_of(chunks)
    if not first:
        next(lines, None)
    held: list[tuple[bytes, int, bool]] = []
    for line in lines:
        held.append(line)
        if not held[0][2]:
            return
        if len(held) == 3 and not (held[0][0].startswith(b"@") and held[2][0].startswith(b"+")):
            held.pop(0)
        elif len(held) == 4:
            header, seq, _, qual = (x.rstrip(b"\r").decode("utf-8", "replace") for x, _, _ in held)
            yield header[1:], seq, qual, held[0][1]
            held = []


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("splitBytes", 64 << 20))

    def partitions(self) -> list[Range]:
        out = []
        for path, size in list_files(self.path):
            fs, inside = open_store(path)
            with fs.open_input_file(inside) as f:
                head = f.read_at(min(512, size), 0)
            kind = "plain" if head[:2] != GZIP[:2] else "blocks" if block_size(head) else "gzip"
            step = size if kind == "gzip" else self.size
            out += [Range(path, a, min(a + step, size), kind) for a in range(0, size, max(1, step))]
        return out or [Range("", 0, 0, "plain")]

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.path:
            return
        fs, inside = open_store(part.path)
        with fs.open_input_file(inside) as f:
            for header, seq, qual, at in records(KINDS[part.kind](f, part.start, part.stop, f.size()), part.start == 0):
                yield header.split(" ")[0], header, seq, qual, header.rsplit(":", 1)[-1], at


class FastqSource(DataSource):
    """Options: path (file, folder, or pattern for its last part, as local path or URI; also gzip), splitBytes.

    Plain files and blocked gzip (as sequencers' tools write it) are split; other gzip is one task for each file. ord grows
    with the record's place in its file.
    """

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def read_fastq(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """Reads from any file system that Arrow opens by URI, or a local path. The barcode is what follows the header's last colon."""
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("splitBytes", split_bytes).load(path)


def read_fastq_text(spark: SparkSession, path: str) -> DataFrame:
    """The same from any store that Spark reads, by lines numbered within each file; ord is the record's number in it.
    """
    i = F.col("line")
    numbered = numbered_lines(spark, path, each_file=True).select("file", F.call_function("div", i, F.lit(4).cast("long")).alias("ord"), (i % 4).alias("k"), "value")
    line = lambda k: F.max(F.when(F.col("k") == k, F.col("value"))).alias(f"l{k}")
    g = numbered.groupBy("file", "ord").agg(line(0), line(1), line(3)).where("length(l0) > 0")
    header = F.expr("substring(l0, 2)")
    return g.select(F.split(header, " ")[0].alias("read_id"), header.alias("header"), F.col("l1").alias("seq"), F.col("l3").alias("qual"), F.element_at(F.split(header, ":"), -1).alias("barcode"), "ord")


def sniff(reads: DataFrame, barcode_length: int) -> str:
    """'sequence' if the first read is longer than a barcode, else 'barcode'."""
    first = reads.select(F.length("seq")).head()
    return "sequence" if first and first[0] > barcode_length else "barcode"
