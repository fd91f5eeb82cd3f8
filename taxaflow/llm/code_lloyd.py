"""Vector code compression: a codebook for each part of a vector, fitted by Lloyd's rounds on delta-maintained sums."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from taxaflow.functions.staging import run_dir

from .common import small_batches, tidy

#: Scaled components have to be below this; what is computed of them is exact up to there.
MOST = 2.0**62
LONG = 2**63 - 1


@dataclass(frozen=True)
class Codebooks:
    """Integer entries, an array (part, entry, position) of Python integers, of vectors of length ``size`` times ``scale``."""

    entries: np.ndarray
    size: int
    scale: float

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry of each part, squared distances) of integer vectors (row, part, position), exact; ties to the lower entry."""
        top = max(int(abs(a).max(initial=0)) for a in (x, self.entries))
        bound = 4 * top * top * max(1, x.shape[2])
        kind = float if bound < 2**53 else np.int64 if bound < 2**62 else object
        x, c = x.astype(kind), self.entries.astype(kind)
        code, dist = np.zeros(x.shape[:2], np.uint8), np.zeros(x.shape[:2], object if kind is object else np.int64)
        for p in range(x.shape[1]):
            far = (x[:, p] * x[:, p]).sum(1)[:, None] - 2 * (x[:, p] @ c[p].T) + (c[p] * c[p]).sum(1)[None, :]
            code[:, p] = best = far.argmin(1)
            dist[:, p] = far[np.arange(len(far)), best]
        return code, dist

    def decode(self, coded: DataFrame, code: str = "code", vector: str = "vector") -> DataFrame:
        """Adds the vector that a code stands for: the middles of its entries' components, in floats of the input."""
        books = F.array(*[F.array(*[F.array(*[F.lit((float(c) + 0.5) / self.scale) for c in e]) for e in part]) for part in self.entries.tolist()])
        one = lambda p: books[p][F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")]
        return coded.withColumn(vector, F.slice(F.concat(*[one(p) for p in range(len(self.entries))]), 1, max(self.size, 1)) if self.size else F.array().cast("array<double>"))


def _cut(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """Lists of longs of one length as an array (row, part, position), filled up with zeros."""
    n = len(column)
    flat = column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0), np.int64)
    out = np.zeros((n, parts * width), np.int64)
    out[:, : flat.shape[1]] = flat
    return out.reshape(n, parts, width)


class Sums:
    """Running sums and counts of the parts assigned to each entry: (part, entry, position), the count last."""

    def __init__(self, parts: int, entries: int, width: int):
        self.held = np.zeros((parts, entries, width + 1), object)

    def add(self, rows: list) -> None:
        flat = self.held.reshape(-1)
        for slot, delta in rows:
            flat[slot] += int(delta)

    def centres(self, before: np.ndarray) -> np.ndarray:
        """floor(sum / count); entries without parts stay as they were."""
        count = self.held[:, :, -1:]
        return np.where(count > 0, self.held[:, :, :-1] // np.maximum(count, 1), before)


def integer_vectors(df: DataFrame, keep: list[str], vector: str, scale: float) -> DataFrame:
    """``keep`` and v, floor(scale * x) of each component, of the rows whose vector is whole: not null, without null and
    non-finite components. A component of ``MOST`` or more when scaled is an error."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(*keep, v.alias("v")).where(F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    whole = lambda c: F.when(F.abs(c) < MOST / scale, F.floor(c * F.lit(float(scale)))).otherwise(F.raise_error(F.lit("a component is too large for exact codes")).cast("long"))
    return rows.withColumn("v", F.transform("v", whole))


def compress(
    df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = (), parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0,
) -> tuple[DataFrame, Codebooks]:
    """(key, ``keep``, code, error) of every whole vector, and the codebooks: code has two hex digits for each part.

    Vectors become integers, floor(scale * x), and are cut into equal consecutive parts (zeros fill up the last one where their
    length isn't a multiple). Each part's entries start as that part of the ``entries`` (256 at most) rows of the smallest
    keys; each round assigns every part to its nearest entry, ties to the lower one, and makes an entry the floored mean
    of its parts; entries without parts stay. The error is the squared distance to the entries of a last assignment.

    Every round writes the assignments beside those of the round before and drops the older table. Only vectors of which a
    part has changed its entry are read again: their tasks add and subtract them in sums of codebook size, of which one
    row for each changed sum and task is shuffled, and the driver holds sums of the codebooks' size alone, as integers without bound.

    Vectors that are null or hold null or non-finite components are left out, as are those of another length than the smallest
    key's. Null keys count as largest; rows of one key go by their vectors, equal rows are vectors each. Fewer rows than
    entries give fewer entries; an empty table gives no rows and empty codebooks. Distances are exact for all components
    below 2^62 when scaled; larger ones, and errors that no long holds, stop the query. Other columns are left out.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits can tell 1 to 256 entries apart")
    spark = df.sparkSession
    small_batches(spark)
    df = tidy(df, [key, vector, *keep])
    rows = integer_vectors(df.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.col(vector).alias("_v")), ["_key", *[f"_keep{i}" for i in range(len(keep))]], "_v", scale)
    folder = f"{run_dir(spark)}/lloyd-{uuid.uuid4().hex}"
    held = [c for c in rows.columns if c != "v"]

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    state = written(rows, "vectors")
    first = [r[0] for r in state.orderBy(F.asc_nulls_last("_key"), "v").select("v").limit(entries).collect()]
    size = len(first[0]) if first else 0
    first = [v for v in first if len(v) == size]
    if len(first) < entries:  # some of the smallest keys' vectors are of another length
        first = [r[0] for r in state.where(F.size("v") == size).orderBy(F.asc_nulls_last("_key"), "v").select("v").limit(entries).collect()]
    width = -(-size // parts)
    start = np.array([v + [0] * (parts * width - size) for v in first], object).reshape(len(first), parts, width)
    books, sums = Codebooks(start.transpose(1, 0, 2), size, scale), Sums(parts, len(first), width)
    state = state.where(F.size("v") == size).withColumn("code", F.lit(None).cast("binary"))

    def assigned(state: DataFrame, books: Codebooks) -> DataFrame:
        schema = T.StructType([*(state.schema[c] for c in [*held, "v"]), *T._parse_datatype_string("was binary, code binary, moved int, error long").fields])
        arrow = to_arrow_schema(schema)

        def run(batches):
            for b in batches:
                column = lambda c: b.column(b.schema.get_field_index(c))
                code, dist = books.assign(_cut(column("v"), parts, width))
                raw, was = [r.tobytes() for r in code], column("code").to_pylist()
                moved = [parts if w is None else sum(x != y for x, y in zip(w, r)) for w, r in zip(was, raw)]
                error = dist.astype(object).sum(1)
                if len(error) and max(error) > LONG:
                    raise OverflowError("an error doesn't fit a long")
                made = [pa.array(was, pa.binary()), pa.array(raw, pa.binary()), pa.array(moved, pa.int32()), pa.array(error.tolist(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*map(column, [*held, "v"]), *made], schema=arrow)

        return state.select(*held, "v", "code").mapInArrow(run, schema)

    def deltas(state: DataFrame) -> DataFrame:
        """(slot, delta): what the parts that moved bring to and take from the sums, added up in each task."""
        shape = sums.held.shape

        def run(batches):
            total = np.zeros(shape, object)
            for b in batches:
                x = _cut(b.column(0), parts, width)
                x = np.concatenate([x, np.ones((*x.shape[:2], 1), np.int64)], 2)
                exact = int(abs(x).max(initial=0)) * len(x) < 2**62
                was, code = (b.column(i).to_pylist() for i in (1, 2))
                some = [i for i, w in enumerate(was) if w is not None]
                for rows, codes, sign in ((np.arange(len(code)), code, 1), (np.array(some, int), [was[i] for i in some], -1)):
                    if len(codes):
                        at = np.frombuffer(b"".join(codes), np.uint8).reshape(-1, parts)
                        own = np.zeros(shape, np.int64 if exact else object)
                        np.add.at(own, (np.arange(parts)[None, :], at), x[rows] if exact else x[rows].astype(object))
                        total += sign * own.astype(object)
            flat = total.reshape(-1)
            slots = [i for i, d in enumerate(flat) if d]
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array([Decimal(flat[i]) for i in slots], pa.decimal128(38, 0))], ["slot", "delta"])

        moved = state.where("moved > 0").select("v", "was", "code").mapInArrow(run, "slot int, delta decimal(38,0)")
        return moved.groupBy("slot").agg(F.sum("delta").alias("delta"))

    spent = "vectors"
    for i in range(rounds):
        state = written(assigned(state, books), f"round-{i}")
        _drop(spark, f"{folder}/{spent}")
        spent = f"round-{i}"
        sums.add(deltas(state).collect())  # a row for each sum: parts * entries * (width + 1) at most
        books = Codebooks(sums.centres(books.entries), size, scale)
    last = written(assigned(state, books).drop("v", "was", "moved"), "codes")
    _drop(spark, f"{folder}/{spent}")
    code = F.lower(F.hex("code")).alias("code")
    return last.select(F.col("_key").alias(key), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], code, "error"), books


def _drop(spark, path: str) -> None:
    """Deletes a table that no later plan reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def with_group_errors(coded: DataFrame, by: str = "label", name: str = "label_error") -> DataFrame:
    """Adds the error summed over the rows of equal ``by``, nulls together."""
    sums = coded.groupBy(F.col(by).alias("_by")).agg(F.sum("error").alias(name))
    return coded.join(sums, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """DuckDB SQL for the query over table ``embeddings``, for vectors whose length is a multiple of ``parts``: the rounds one after the
    other, each over all rows."""
    steps = [f"""v AS (
  SELECT row_number() OVER () AS row, vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
p AS MATERIALIZED (
  SELECT row, part, v[(len(v) // {parts}) * part + 1 : (len(v) // {parts}) * (part + 1)] AS x FROM v, range({parts}) AS r(part)),
first AS (SELECT row, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM v QUALIFY entry < {entries}),
c0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN first USING (row))"""]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (
  SELECT row, part, entry, CAST(coalesce(list_sum([(x[k] - c[k]) * (x[k] - c[k]) FOR k IN range(1, len(x) + 1)]), 0) AS BIGINT) AS far FROM p JOIN c{i} USING (part)),
a{i} AS MATERIALIZED (SELECT row, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM d{i} GROUP BY row, part)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
  SELECT part, entry, k, CAST(floor(sum(x[k]) / count(*)) AS BIGINT) AS m FROM p JOIN a{i} USING (row, part), (SELECT unnest(range(1, n + 1)) AS k FROM (SELECT len(x) AS n FROM p LIMIT 1)) GROUP BY ALL),
m{i} AS (SELECT part, entry, list(m ORDER BY k) AS m FROM s{i} GROUP BY part, entry),
c{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m, c) AS c FROM c{i} LEFT JOIN m{i} USING (part, entry))""")
    return "WITH " + ",\n".join(steps) + f""",
e AS (SELECT row, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
l AS (SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error FROM v JOIN e USING (row))
SELECT vec_id, code, error, label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256 FROM l"""
