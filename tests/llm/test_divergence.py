import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from taxaflow.llm import divergence, queries
from tests.llm.helpers import DOC, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
FIELDS = ["lang", "source", "part", "item", "value", "rank"]


def plain(rows, least=3, top=200):
    """The audit of (text, lang, source) rows, all groups over all kept terms."""
    terms = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    out = []
    for lang in {x for x, _, _ in terms}:
        own = [(s, t) for x, s, t in terms if x == lang]
        kept = [t for t, n in Counter(t for _, ts in own for t in set(ts)).items() if n >= least]
        count = {s: Counter() for s, _ in own}
        for s, ts in own:
            count[s].update(ts)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}  # noqa: B023, E731
        p, q = {s: share(c) for s, c in count.items()}, share(sum(count.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in count:
            parts = {"pair": [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in count if o != s], "term": [(f(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]}
            for part, found in parts.items():
                ranked = sorted(found, key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in FIELDS) for r in df.collect())


def test_query(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op13_divergence(spark, SF)
    rows = spark_rows(got)
    assert sorted(tuple(dict(zip(sorted(got.columns), r))[c] for c in FIELDS) for r in rows) == plain([(r.text, r.lang, r.source) for r in docs.collect()])
    assert duck_rows(divergence.sql(), tmp_path, documents=docs) == rows


ODD = [(None, None, None), ("", "en", "a"), ("One two, TWO three3four", "en", "a"), ("ÄÖ äö é two", "en", None), ("two three ÄÖ", "en", "b"), ("three two ÄÖ", "en", "b"), ("alone", "fr", "a"), ("alone", "fr", "b"), ("x" * 100_000 + " two", "en", "c"), ("nothing here", "de", "a")]


@pytest.mark.parametrize("least,top,block", [(3, 200, 256), (1, 2, 1), (2, 1, 2)])
def test_odd_rows(spark, least, top, block):
    rows = ODD + [("two same words", "en", "a")] * 40
    docs = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", F.lit("x").alias("Source"), F.lit(1).alias("gid"), F.lit(1).alias("term"))
    assert found(divergence.audit(docs, least_docs=least, top=top, block=block)) == plain(rows, least, top)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], DOC)).count() == 0


@pytest.mark.parametrize("k", [1, 3, 7, 1000])
def test_radix_selection(spark, k):
    """Ties at the threshold, among them items that begin alike, are cut by bytes."""
    items = ["a" * n + x for n in range(6) for x in ("", "b", "é", "日", "z", "\U0001f600", "a\x01")]
    cells = [(g, item, v) for g in range(3) for i, item in enumerate(dict.fromkeys(items)) for v in [(5, 2**60 - 1, i % 3)[g]]]
    cells += [(9, f"t{i:05}", (i * 7919) % 1000 * 10**15) for i in range(3000)]
    df = spark.createDataFrame(cells, "gid long, item string, value long")
    got = sorted((r.gid, r["item"], r.value) for r in divergence.select_top(df, k).collect())
    want = [c for g in {c[0] for c in cells} for c in sorted((c for c in cells if c[0] == g), key=lambda c: (-c[2], c[1].encode()))[:k]]
    assert got == sorted(want)
