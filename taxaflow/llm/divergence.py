"""Source divergence audit: what each source's word use has over its language's, and how far sources are from each other.

Term shares are scaled integers, p = 1 + floor(10^9 * (count + 1) / (N + V)), and the distance of two is floor((p - q)^2 / q).
Top terms are found by radix selection, distances of sources from counted cells alone; all arithmetic is exact.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.ordering import row_number

from .common import materialize, sliced, small_batches, tidy

SCALE = 1_000_000_000
#: Bytes of a text as a term's letters: A-Z lower-cased, a-z and all beyond ASCII as they are, others a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(docs: DataFrame, most: int = 400_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, added up in each task for up to ``most`` terms at a time."""
    small_batches(docs.sparkSession)

    def run(batches):
        n: dict = {}
        in_docs: dict = {}
        held = 0

        def flush():
            groups = [(k, n[k], in_docs[k]) for k in n]
            n.clear(), in_docs.clear()
            for (lang, source), counts, per in groups:
                terms = list(counts)
                for a in range(0, len(terms), 4096):
                    some = terms[a : a + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(some, pa.binary()).cast(pa.string()), pa.array([counts[t] for t in some], pa.int64()), pa.array([per[t] for t in some], pa.int64())],
                        ["lang", "source", "term", "n", "docs"])

        for whole in batches:
            for b in sliced([whole], ["text"]):
                for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                    words, group = text.translate(_LETTERS).split(), (lang, source)
                    if group not in n:
                        n[group], in_docs[group] = Counter(), Counter()
                    before = len(n[group])
                    n[group].update(words)
                    in_docs[group].update(set(words))
                    held += len(n[group]) - before
                if held > most:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, size: Column) -> Column:
    """p, exact for counts up to 10^18."""
    exact = lambda c: c.cast("decimal(19,0)")
    return (F.lit(1) + F.call_function("div", exact(count + 1) * F.lit(SCALE).cast("decimal(10,0)"), exact(total + size))).cast("long")


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def kept_cells(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n, first): the cells of terms in ``least_docs`` documents of their language or more;
    ``first`` marks one cell of each term. One shuffle, by language and term, serves both sums."""
    dealt = counts.repartition(F.col("lang"), F.col("term"))
    cells = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    each = Window.partitionBy("lang", "term")
    cells = cells.withColumn("lang_n", F.sum("n").over(each)).withColumn("_docs", F.sum("docs").over(each)).withColumn("_least", F.min("source").over(each))
    return cells.where(F.col("_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("_least")).alias("first"))


def _groups(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """(gid, lang, source, total, size, base, lang_total) of every group; ``base`` is the share of terms it lacks, null without kept terms."""
    lang = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("size"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_rows")).drop("_rows")
    both = every.join(own, ["lang", "source"], "left").join(lang, "lang", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("total", "size", "lang_total")})
    numbered = row_number(both, [F.col("lang").asc(), F.col("source").asc()], "gid")
    return numbered.withColumn("base", F.when(F.col("size") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("size", F.lit(1)))))


def _at_threshold(groups_digits: DataFrame, k_left: Column, ascending: bool) -> DataFrame:
    """(gid, digit, need): the digit at which a group's running count reaches what it needs, and what is needed within it."""
    over = Window.partitionBy("gid").orderBy(F.col("digit").asc() if ascending else F.col("digit").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = groups_digits.withColumn("_upto", F.sum("cells").over(over))
    return run.where((F.col("_upto") >= k_left) & (F.col("_upto") - F.col("cells") < k_left)).select("gid", "digit", (k_left - F.col("_upto") + F.col("cells")).alias("need"), "cells")


def select_top(cells: DataFrame, k: int, bits: int = 12, width: int = 60, text_step: int = 2) -> DataFrame:
    """The k cells (gid, item, value) of each group with the largest values, ties to the smaller item by UTF-8 bytes.

    Values are under 2^width. A round counts each group's candidates by the next ``bits`` of their values, in a
    distributed histogram of at most 2^bits rows for a group; the digit at which the count from above reaches k is the next
    of the kth value: candidates above are selected, those below are out, those at it go on. Where more cells
    have the kth value than are needed, the same is done with ``text_step`` bytes of the item at a time, from below. Groups
    of k cells or fewer are selected whole. The items of a group are distinct.
    """
    need = cells.groupBy("gid").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > k).select("gid", F.lit(k).cast("long").alias("need"))
    need = materialize(need, "radix-need")
    chosen = [cells.join(need.select("gid"), "gid", "left_anti")]
    left = cells.join(need.select("gid"), "gid", "left_semi")
    place = 0
    shift = width - bits
    while not need.isEmpty():
        if shift > -bits:
            digit = F.shiftright("value", max(shift, 0)).bitwiseAND(F.lit((1 << min(bits, bits + shift)) - 1))
            ascending = False
            shift -= bits
        else:  # all that is left of a group has one value
            digit, ascending = F.hex(F.substring(F.col("item").cast("binary"), place * text_step + 1, text_step)), True
            place += 1
        marked = left.withColumn("digit", digit)
        counts = marked.groupBy("gid", "digit").agg(F.count(F.lit(1)).alias("cells")).join(need, "gid")
        at = materialize(_at_threshold(counts, F.col("need"), ascending), "radix-threshold")
        both = marked.join(at.select("gid", F.col("digit").alias("_at"), F.col("need").alias("_need"), F.col("cells").alias("_cells")), "gid")
        inside = F.col("digit") < F.col("_at") if ascending else F.col("digit") > F.col("_at")
        both = materialize(both.where(inside | (F.col("digit") == F.col("_at"))).withColumn("_in", inside | (F.col("_need") == F.col("_cells"))), "radix-cells")
        chosen.append(both.where("_in").select(*cells.columns))
        left = both.where("not _in").select(*cells.columns)
        need = at.where("need < cells").select("gid", "need")
    out = chosen[0]
    for c in chosen[1:]:
        out = out.unionByName(c)
    return out


def _shared_terms(cells: DataFrame, groups: DataFrame, block: int, most: int = 200_000) -> DataFrame:
    """(g, h, value): over the terms that both groups have, f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), summed by tasks.

    Groups of a language are dealt to blocks of ``block``; a cell goes to each pair of blocks that its own is in (to one
    pair where a language has one block). Cells of one term and pair of blocks, two blocks' worth at most, stand
    together in a sorted stream, in which each is paired with those after it.
    """
    blocks = groups.groupBy("lang").agg(F.min("gid").alias("_from"), F.max("gid").alias("_to"))
    cut = lambda c: F.call_function("div", c - F.col("_from"), F.lit(block).cast("long")).cast("int")
    own = groups.join(blocks, "lang").select("lang", "source", "gid", "base", cut(F.col("gid")).alias("_x"), cut(F.col("_to")).alias("_last"))
    each = cells.select("lang", "source", "term", "gid", "p").join(own.select("gid", "base", "_x", "_last"), "gid").withColumn("_y", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    each = each.select("lang", "term", "gid", "p", "base", "_x", F.least("_x", "_y").alias("_a"), F.greatest("_x", "_y").alias("_b"))
    key = ["lang", "term", "_a", "_b"]
    dealt = each.repartition(*[F.col(c) for c in key]).sortWithinPartitions(*key)

    def run(batches):
        sums: dict = {}

        def add(parts):
            parts = list(parts)
            if parts:
                g, h, v = map(np.concatenate, zip(*parts))
                pairs, where = np.unique(g << 31 | h, return_inverse=True)
                total = np.zeros(len(pairs), np.int64)
                np.add.at(total, where, v)
                for pair, x in zip(pairs.tolist(), total.tolist()):
                    sums[pair] = sums.get(pair, 0) + x

        def flush():
            keys = list(sums)
            for a in range(0, len(keys), 4096):
                some = keys[a : a + 4096]
                yield pa.RecordBatch.from_arrays([pa.array([x >> 31 for x in some]), pa.array([x & (1 << 31) - 1 for x in some]), pa.array([sums[x] for x in some], pa.int64())], ["g", "h", "value"])
            sums.clear()

        rest = None
        for b in batches:
            rest = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            new = _new_run(rest, key)
            cut = int(np.flatnonzero(new)[-1])  # the last term may go on in the next batch
            if cut:
                add(_pairs(rest.slice(0, cut), new[:cut]))
                rest = rest.slice(cut)
            if len(sums) > most:
                yield from flush()
        if rest is not None and rest.num_rows:
            add(_pairs(rest, _new_run(rest, key)))
        yield from flush()

    return dealt.mapInArrow(run, "g long, h long, value long").groupBy("g", "h").agg(F.sum("value").alias("value"))


def _new_run(t: pa.Table, key: list[str]) -> np.ndarray:
    """Whether a row differs from the one before in ``key``."""
    new = np.ones(t.num_rows, bool)
    if t.num_rows > 1:
        new[1:] = False
        for c in key:
            x = t[c].combine_chunks()
            new[1:] |= ~pc.equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
    return new


def _pairs(t: pa.Table, new: np.ndarray):
    """Both orders of each pair of cells of a term, from different blocks unless both of the pair's are one."""
    g, p, base, x, a, b = (t[c].to_numpy() for c in ("gid", "p", "base", "_x", "_a", "_b"))
    run = np.cumsum(new)
    for d in range(1, int(np.bincount(run).max(initial=1))):
        i = np.flatnonzero(run[d:] == run[:-d])
        if not len(i):
            break
        i = i[(x[i] != x[i + d]) | (a[i] == b[i])]
        for one, two in ((i, i + d), (i + d, i)):
            yield g[one], g[two], _apart(p[one], p[two]) - _apart(p[one], base[two]) - _apart(base[one], p[two]) + _apart(base[one], base[two])


def _one_sided(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(g, h, value): over the terms of one of both groups, what its share adds to f(p0, q0) against the other's base.

    A group's cells are counted by their shares first, which are far fewer than its terms; each of these counts meets
    the other groups of the language, as the result itself has a row for each of them.
    """
    shares = cells.groupBy("gid", "p").agg(F.count(F.lit(1)).alias("_m"))
    own = groups.select("gid", "lang", F.col("base").alias("_g0"))
    other = groups.select(F.col("gid").alias("_o"), "lang", F.col("base").alias("_h0"))
    met = shares.join(own, "gid").join(other, "lang").where("gid <> _o")
    p, g0, h0 = (F.col(c) for c in ("p", "_g0", "_h0"))
    there, back = F.col("_m") * (apart(p, h0) - apart(g0, h0)), F.col("_m") * (apart(h0, p) - apart(h0, g0))
    sums = met.groupBy("gid", "_o").agg(F.sum(there).alias("_there"), F.sum(back).alias("_back"))
    both = F.array(F.struct(F.col("gid").alias("g"), F.col("_o").alias("h"), F.col("_there").alias("value")), F.struct(F.col("_o").alias("g"), F.col("gid").alias("h"), F.col("_back").alias("value")))
    return sums.select(F.explode(both).alias("r")).select("r.*")


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 3, top: int = 200, block: int = 256) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of language and source.

    Part ``term``: the ``top`` kept terms whose share in the group is above the language's, by their distance from it.
    Part ``pair``: every other source of the language by the distance of the group from it, summed over all kept terms.
    Ranks go from 1, larger values first, ties by the item's UTF-8 bytes. Terms are runs of ASCII letters (lower-cased) and
    characters beyond ASCII; a language keeps those in ``least_docs`` of its documents or more.

    Distances of pairs come from counted cells: all kept terms at both groups' base shares, corrected for the terms of
    one group by counts of its shares, and for those of both by sums over pairs of cells of a term.

    Null text, language and source are empty strings. Repeated rows are documents each; long texts are read whole. A
    language without kept terms has distances of 0; a language of one source has no pairs. An empty table gives no
    rows; other columns are left out. Intermediate tables stay until ``clean_run``.
    """
    docs = tidy(docs, [lang, source, text])
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    cells = materialize(kept_cells(count_terms(docs), least_docs), "term-cells")
    groups = materialize(_groups(docs, cells), "groups")
    about = groups.select("gid", "lang", "source", "total", "size", "lang_total")
    shared = cells.join(about, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("size"))).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("size")))
    shared = materialize(shared.select("gid", "lang", "source", "term", "p", "q"), "term-shares")

    above = shared.where("p > q").select("gid", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    terms = select_top(above, top).withColumn("part", F.lit("term"))

    names = groups.select("gid", "lang", "source", "base", "size")
    one, two = names.select(F.col("gid").alias("g"), "lang", "size", F.col("base").alias("_g0")), names.select(F.col("gid").alias("h"), "lang", F.col("source").alias("item"), F.col("base").alias("_h0"))
    pairs = one.join(two, "lang").where("g <> h")
    common = F.coalesce(F.col("size") * apart(F.col("_g0"), F.col("_h0")), F.lit(0).cast("long"))
    fixes = _one_sided(shared, groups).unionByName(_shared_terms(shared, groups, block)).groupBy("g", "h").agg(F.sum("value").alias("fix"))
    pairs = pairs.join(fixes, ["g", "h"], "left").select(F.col("g").alias("gid"), "item", (common + F.coalesce("fix", F.lit(0).cast("long"))).alias("value"), F.lit("pair").alias("part"))

    order = Window.partitionBy("gid", "part").orderBy(F.desc("value"), "item")
    ranked = terms.unionByName(pairs).withColumn("rank", F.row_number().over(order))
    return ranked.join(names.select("gid", "lang", "source"), "gid").select("lang", "source", "part", "item", "value", "rank")


def sql(least_docs: int = 3, top: int = 200) -> str:
    """DuckDB SQL for ``audit`` over table ``documents``: every group's share of every kept term, and all of them compared."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= {least_docs}),
l AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS HUGEINT) AS lang_total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, CAST(coalesce(total, 0) AS HUGEINT) AS total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + 1)) // (total + v) AS p, 1 + ({SCALE}::HUGEINT * (lang_n + 1)) // (lang_total + v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C") AS INT) AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= {top}"""
