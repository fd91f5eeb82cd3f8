"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from taxaflow.functions.batches import sliced, small_batches
from taxaflow.functions.staging import materialize, shared_dir

__all__ = ["WORD", "WordHashes", "filter_rows", "map_columns", "materialize", "mix64", "n_words", "python_values", "row_hash", "shared_dir", "shingle_hashes", "sliced", "small_batches", "table", "tidy", "word_hashes"]

#: A word is a run of characters other than ASCII white space; ``bytes.split()`` cuts UTF-8 in the same places.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def tidy(df: DataFrame, needed: list[str], added: list[str] | tuple = ()) -> DataFrame:
    """Input without clashing names, so that operators can rely on theirs.

    Columns that an operator adds replace input columns of the same name, and of columns that share a name (letter case
    aside) the one spelled as needed stays, else the first.
    """
    new, at = {c.lower() for c in added}, {}
    for i, c in enumerate(df.columns):
        if c in needed or c.lower() not in new:
            known = at.get(c.lower())
            if known is None or (c in needed and df.columns[known] not in needed):
                at[c.lower()] = i
    if len(at) == len(df.columns):
        return df
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{i}").alias(df.columns[i]) for i in sorted(at.values())])


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A hash of all columns and of which of them are null."""
    values = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in k or k == "variant" else F.col(f"`{c}`") for c, k in df.dtypes]
    return F.xxhash64(F.lit(seed), *[x for v in values for x in (v.isNull(), v)])


def python_values(column: pa.Array) -> list:
    """The values of a column; lists of integers as NumPy arrays, which take far less than Python's."""
    if not (pa.types.is_list(column.type) and pa.types.is_integer(column.type.value_type)) or column.values.null_count:
        return column.to_pylist()
    at, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] if ok else None for a, b, ok in zip(at, at[1:], column.is_valid().to_pylist())]


def map_columns(df: DataFrame, keep: list[str], used: list[str], added: str, fn, rows: int = 256) -> DataFrame:
    """``keep`` as they are and the columns ``added`` (DDL), which ``fn`` makes of lists of the values in ``used``,
    ``rows`` rows at a time."""
    small_batches(df.sparkSession)
    new = T._parse_datatype_string(added)
    schema = T.StructType([df.schema[c] for c in keep] + new.fields)
    arrow = [to_arrow_type(f.dataType) for f in new.fields]

    def run(batches):
        for b in sliced(batches, used, rows):
            made = fn(*(python_values(b.column(b.schema.get_field_index(c))) for c in used))
            columns = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(columns + [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, arrow)], names=schema.names)

    return df.select(*dict.fromkeys([*keep, *used])).mapInArrow(run, schema)


def filter_rows(df: DataFrame, used: list[str], fn) -> DataFrame:
    """The rows for which ``fn``, given lists of the values in ``used``, says True."""
    small_batches(df.sparkSession)

    def run(batches):
        for b in sliced(batches, used):
            yield b.filter(pa.array(fn(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in used)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64's), element-wise."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hashes of words, kept for the life of a worker and emptied when they grow past ``limit``."""

    limit = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each window of ``width`` words, in text order; a shorter text has one window, its whole."""
    n = len(words)
    if n == 0:
        return words
    span = min(width, n)
    out = np.zeros(n - span + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(span):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += words[k : n - span + 1 + k]
    return mix64(out)
