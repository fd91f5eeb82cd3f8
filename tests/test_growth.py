"""Operators whose results are grids or pairs: what they hold and shuffle on the way."""

import io
import random
import re
from contextlib import redirect_stdout

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from taxaflow.functions import staging
from taxaflow.operators import barcodes, classify, cluster, derep, hits, near, reads, report, search, stats, table
from taxaflow.plans import adapters, lists, sequencing, tables


def plan_of(df):
    with redirect_stdout(out := io.StringIO()):
        df.explain()
    return out.getvalue()


def test_grid_is_made_from_blocks(spark):
    cells = [("a", "x", 3), ("a", "y", 1), ("b", "y", 4), ("c", "z", 0), ("d", "v", 2), ("d", "v", 5)]
    ft = spark.createDataFrame(cells, "tu_id string, sample_id string, n long")
    out = table.with_pseudocount(ft, block=2)
    units, samples = sorted({c[0] for c in cells}), sorted({c[1] for c in cells})
    want = []
    for s in samples:
        total = sum(n for _, x, n in cells if x == s) + len(units)
        for u in units:
            own = [n for t, x, n in cells if (t, x) == (u, s)] or [0]
            want += [(u, s, n, (n + 1) / total) for n in own]
    got = sorted(tuple(r) for r in out.select("tu_id", "sample_id", "n", "rel").collect())
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in sorted(want)])
    assert "explode" in plan_of(out)  # cells are made by a row for each unit and block


def test_cells_that_a_grid_lacks_are_dealt_by_their_number_and_rounded_by_sample(spark, monkeypatch):
    monkeypatch.setattr(table, "CELLS_OF_TASK", 50)
    cells = [(f"u{i:02d}", f"s{i % 7 * j % 23:02d}", i + j) for i in range(60) for j in range(1 + i % 3)] + [("none", None, 2), ("empty", "s01", None)]
    ft = spark.createDataFrame(cells, "tu_id string, sample_id string, n long").groupBy("tu_id", "sample_id").agg(F.sum("n").alias("n"))
    out, whole = table.with_pseudocount(ft, block=4, digits=3), table.with_pseudocount(ft)
    samples = {c[1] for c in cells if c[1]}
    assert out.rdd.getNumPartitions() >= 62 * len(samples) // 50
    got, want = ({(r.tu_id, r.sample_id): (r.n, round(r.rel, 3)) for r in x.collect()} for x in (out, whole))
    assert got == want and len(got) == 62 * len(samples) == out.count()


def test_pairs_of_blocks_are_dealt_to_as_many_tasks_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(stats, "PAIRS_OF_TASK", 4)
    rows = [(f"u{i:02d}", s, (i * 7 + s * s * (i % 5 + 1)) % 11) for i in range(60) for s in range(6)]
    df = spark.createDataFrame(rows, "u string, s long, v long")
    out = stats.correlate_units(df, "u", "s", "v", block=4)
    assert out.rdd.getNumPartitions() >= 120 // 4  # 15 blocks


def test_units_of_equal_ranks_are_correlated_once(spark, monkeypatch):
    seen, keep = [], stats.block_pairs
    monkeypatch.setattr(stats, "block_pairs", lambda packed, *a: seen.append(packed.count()) or keep(packed, *a))
    base = [[3, 1, 2, 0, 0], [5, 1, 4, 0, 0], [0, 1, 0, 2, 3], [7, 7, 7, 7, 7], [1, 2, 3, 4, 5]]  # the first two have equal ranks
    data = {f"u{i}": [x * (1 + i // 5) for x in base[i % 5 if i < 40 else 0]] for i in range(60)} | {None: [1, 2, 3, 4, 5]}
    df = spark.createDataFrame([(u, s, v) for u, x in data.items() for s, v in enumerate(x)], "u string, s int, v long")
    of = lambda x: [sum(y < v for y in x) + (sum(y == v for y in x) + 1) / 2 - (len(x) + 1) / 2 for v in x]
    for high, low in ((0.0, 0.0), (0.85, -0.85)):
        want = {}
        for a in data:
            for b in data:
                if a is not None and b is not None and a < b:
                    x, y = of(data[a]), of(data[b])
                    down = (sum(v * v for v in x) * sum(v * v for v in y)) ** 0.5
                    rho = sum(p * q for p, q in zip(x, y)) / down if down else 0.0
                    if rho >= high or rho <= low:
                        want[a, b] = round(rho, 6)
        rows = stats.correlate_units(df, "u", "s", "v", high=high, low=low, block=6, digits=6).collect()
        got = {(r.a, r.b): r.rho for r in rows}
        assert len(rows) == len(got) and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert seen == [4, 4]


def test_reads_are_mapped_by_the_keys_of_their_clusters(spark, monkeypatch):
    rng, seqs = random.Random(4), []
    for k in range(5):
        base = [rng.choice("ACGT") for _ in range(100)]
        for i in range(24):
            s = base[:]
            for at in rng.sample(range(100), i % 6):
                s[at] = rng.choice("ACGT")
            seqs.append("".join(s))
    rows = [(f"r{i}", f"s{i % 3}", seqs[i % len(seqs)]) for i in range(150)]
    df = spark.createDataFrame(rows, "read_id string, sample_id string, seq string")
    calls, keep = [], near.shared_keys
    for m in (near, cluster):
        monkeypatch.setattr(m, "shared_keys", lambda *a: calls.append(1) or keep(*a))
    monkeypatch.setattr(sequencing, "cut_reads", lambda s, d: df)
    got = {tuple(r) for r in sequencing.map_reads_to_units(spark, "").collect()}
    assert len(calls) == 1 and len(got) == 150
    units = {r.tu_id: (r.centroid_ord, r.centroid) for r in cluster.cluster(derep.uniques(df), 0.97).collect()}
    assert 5 < len(units) < len(set(seqs))
    duck = duckdb.connect()
    for read, sample, seq in rows:
        d, _, unit = min((duck.execute("select levenshtein(?, ?)", [seq, c]).fetchone()[0], o, u) for u, (o, c) in units.items())
        assert (read, sample, unit, round(1 - d / 100, 9)) in got


def test_barcodes_with_a_near_one_are_not_compared_further(spark, monkeypatch):
    near, seen = barcodes.near_pairs, {}

    def noted(counts, sample_map, most=2):
        seen[most] = sorted(r.barcode for r in counts.collect())
        return near(counts, sample_map, most)

    monkeypatch.setattr(barcodes, "near_pairs", noted)
    smap = spark.createDataFrame([("s1", "ACGTAC"), ("s2", "ACGTTT"), ("s3", "GGGGGG")], "sample_id string, barcode string")
    read = ["ACGTAC", "ACGTACG", "ACGTAT", "GGGGGC", "GGGGCC", "TTTTTT", "ACG"]
    got = {r.barcode: (r.d, r.ties, r.kind) for r in barcodes.collisions(spark.createDataFrame([(b, 1) for b in read], "barcode string, n long"), smap, 2).collect()}
    assert got == {"ACGTAC": (0, 1, "bc"), "ACGTACG": (0, 1, "bc"), "ACGTAT": (1, 2, "*1"), "GGGGGC": (1, 1, "m1"), "GGGGCC": (2, 1, "m2")}
    assert seen[2] == sorted(["GGGGCC", "TTTTTT", "ACG"])


def test_classifier_cuts_out_only_words_that_queries_have(spark):
    refs = spark.createDataFrame([("abcdefghij" * 3, ["d__a"]), ("abcdefgh" + "é" * 9, ["d__a"]), ("zzabcdefghzz", ["d__b"]), ("".join(chr(33 + i % 90) for i in range(900)), ["d__c"])], "seq string, lineage array<string>")
    queries = spark.createDataFrame([("q", "xxabcdefghij"), ("r", "éééééééééb")], "qseqid string, seq string")
    whole, cut = classify.train(refs), classify.train(refs, queries=queries)
    answers = [sorted((r.qseqid, r.taxonomy, r.confidence, round(r.score, 9)) for r in classify.classify(queries, m).collect()) for m in (whole, cut)]
    assert answers[0] == answers[1] and len(answers[0]) == 2
    assert cut.gains.count() < whole.gains.count() / 10


def test_tasks_count_words_before_they_are_shuffled(spark):
    refs = spark.createDataFrame([("a", "abcdefghij")] * 50, "taxon string, seq string").coalesce(1)
    got = sorted(tuple(r) for r in classify.counted_words(refs, 8, None).collect())
    assert got == [("a", "abcdefgh", 50), ("a", "bcdefghi", 50), ("a", "cdefghij", 50)]


def test_reads_that_may_match_bring_only_words_that_pass(spark):
    ref = spark.createDataFrame([("ACGTTGCATGCCATAGGACTTACGAT",)], "seq string")
    df = spark.createDataFrame([("x", "é" * 40 + "TTTT" + "ACGTTGCATGCCATAGGACTTACGAT"), ("y", "G" * 60), ("z", None)], "read_id string, seq string")
    met = reads._may_match(df, reads.bloom_filter(ref, 20), 20, 4).collect()
    assert [r.read_id for r in met] == ["x"] and set(range(44, 51)) <= set(met[0]._places) and len(met[0]._places) < 20
    assert all(w == met[0].seq[p : p + 20] for w, p in zip(met[0]._words, met[0]._places))
    assert [r.read_id for r in reads.matching_reads(df, ref, 20, identity=0.97).collect()] == ["x"]


def test_rank_correlation_of_arrays_equals_that_of_rows(spark):
    nan = float("nan")
    sides = [([3.0, 1.0, 2.0, 2.0], [1.0, 5.0, 2.0, 9.0]), ([1.0, 1.0], [2.0, 3.0]), ([], []), ([4.0], [4.0]), ([nan, 1.0, nan, 0.5], [3.0, 1.0, 2.0, 2.0]), ([1.0, 2.0, 3.0], [2.0, 4.0, 9.0])]
    arrays = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(sides)], "u long, a array<double>, b array<double>")
    rows = spark.createDataFrame([(i, x, y) for i, (a, b) in enumerate(sides) for x, y in zip(a, b)], "u long, a double, b double")
    want = {r.u: (r.n, r.rho and round(r.rho, 9)) for r in stats.spearman(rows, "u", "a", "b").collect()}
    got = {r.u: (r.n, r.rho and round(r.rho, 9)) for r in stats.with_rho(arrays, "a", "b").collect()}
    assert got == want | {2: (0, None)}


def test_means_are_computed_once_for_their_changes(spark):
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"u{i}", p, g, float((i * 7 + 3 * j) % 11 + k)) for i in range(20) for j, g in enumerate("abc") for k, p in enumerate(("before", "after"))]
    means = spark.createDataFrame(rows, "tu_id string, phase string, grp string, mean double")
    got = stats.correlate_with_change(means.mapInArrow(noted, means.schema), "phase", "grp", "before", "before", "after")
    assert got.count() == 20 and seen.value == len(rows)
    external = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "name string, value double")
    assert stats.correlate_with_external(got, external).count() == 20 and seen.value == len(rows)


def test_tasks_keep_their_size_when_a_table_grows(spark, tmp_path, monkeypatch):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.unset(keys[2])
        spark.conf.set(keys[0], "64m"), spark.conf.set(keys[1], "8m")
        spark.range(100_000).write.parquet(f"{tmp_path}/t.parquet")
        adapters.read(spark, str(tmp_path), "t")
        assert [spark.conf.get(k, None) for k in keys] == ["16777216b", "8m", None]
        monkeypatch.setattr(adapters, "TASK_BYTES", 1 << 16)
        assert adapters.read(spark, str(tmp_path), "t").count() == 100_000
        assert spark.conf.get(keys[0]) == "65536b" and int(spark.conf.get(keys[2])) > 4
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hits_of_a_query_are_shuffled_once_for_their_depth(spark):
    rows = [("a", "s1", 0.0, 1, 1), ("a", "s2", -0.0, 2, 2), ("b", "s1", 9.0, 1, 1), ("b", "s1", 8.0, 2, 2), ("c", "s1", 9.0, 1, 1), ("c", "s2", 8.0, 2, 2), ("d", "s1", None, 3, 1), ("d", "s2", 5.0, 4, 2), ("e", "s1", None, None, 1)]
    out = hits.not_enough_hits(spark.createDataFrame(rows, "qseqid string, sseqid string, pident double, mismatch int, hit_ord long"))
    assert plan_of(out).count("Exchange") == 1
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1, 2), ("b", 1, 1), ("d", 1, 2)]


def test_tasks_hold_the_words_of_a_few_sequences(spark):
    rows = [(f"s{i}", None if i % 50 == 7 else "".join(chr(33 + (i * 31 + j * j) % 90) for j in range(i % 97 * 40))) for i in range(3000)]
    whole = pa.RecordBatch.from_pylist([{"id": a, "seq": t} for a, t in rows])
    got = list(search._seeds([whole, whole.slice(0, 0)], ["id"], 8, 5))
    assert len(got) >= 12 and max(len(b.column(0).unique()) for b in got) <= 256
    want = [(a, w, p) for a, t in rows for w, p in zip(*(x.tolist() for x in search.minimisers((t or "").encode(), 8, 5)))]
    assert [tuple(r.values()) for b in got for r in b.to_pylist()] == want
    df = spark.createDataFrame(rows, "id string, seq string")
    found = search.seed_words(df, ["id"], 8, 5)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1024
    assert found.count() == len(want)


def test_deepening_checks_hits_once_and_not_after_the_last_round(spark, monkeypatch):
    lineitem = [(o, p, p % 7, n, 10.0 * n, 1.0 * o, 0.1 * (n % 2), 0.0) for o in range(40) for n, p in enumerate(range(o % 5 + 1), 1)]
    part = [(p, f"name {p}", "b", "t") for p in range(9)]
    tables = {
        "lineitem": spark.createDataFrame(lineitem, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
        "part": spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string"),
        "orders": spark.createDataFrame([(o, 100.0 + o) for o in range(40)], "o_orderkey long, o_totalprice double"),
    }
    read, written = [], []
    monkeypatch.setattr(adapters, "read", lambda s, d, name: read.append(name) or tables[name])
    for m in (lists, hits):
        monkeypatch.setattr(m, "materialize", lambda df, name, keep=staging.materialize: written.append((name, df.columns)) or keep(df, name))
    out = lists.deepened_hits(spark, "")
    assert [n for n, _ in written] == ["hits", "deeper", "deeper-hits"] and read.count("lineitem") == 1
    assert written[2][1] == ["qseqid", "sseqid", "pident", "mismatch", "hit_ord"] and "l_orderkey" not in plan_of(out)
    many = {o: min(o % 5 + 1, 2) for o in range(40)}
    alike = {o for o in many if many[o] == 1}  # those of two hits differ in identity and mismatches
    want = {(str(o), i): (i <= 2) + (o in alike) for o in range(40) for i in range(1, o % 5 + 2)}
    assert {(r.qseqid, r.hit_ord): r.times for r in out.collect()} == {k: n for k, n in want.items() if n}


@pytest.mark.parametrize("mode", ["average", "per_treatment"])
def test_compositions_need_no_sums_by_sample_nor_broadcast_lineages(spark, mode):
    cells = [(f"u{u}", f"s{s}", float((u * 5 + s * 3) % 7)) for u in range(30) for s in range(8) if (u + s) % 3] + [("none", "s1", 2.0), (None, "s2", 3.0)]
    rel = spark.createDataFrame(cells, "tu_id string, sample_id string, rel double")
    lineages = spark.createDataFrame([(f"u{u}", None if u == 3 else [f"d{u % 2}", f"k{u % 6}", f"p{u}"]) for u in range(30)], "tu_id string, lineage array<string>")
    meta = spark.createDataFrame([(f"s{s}", f"t{s % 3}" if s else None) for s in range(9)], "sample_id string, t string")
    named = table.with_taxon(rel, lineages, 2, "rel")
    summed = table.collapse(rel, lineages, 2, "rel")
    assert "BroadcastHashJoin" not in plan_of(named) and {r.taxon for r in named.collect()} == {f"d{k % 2};k{k}" for k in range(6)} | {"k__Unassigned"}
    outs = [report.composition(x, meta, "t", n=2, mode=mode) for x in (named, summed)]
    assert not [line for line in plan_of(outs[0]).splitlines() if "HashAggregate(keys=[taxon" in line and "sample_id" in line]
    got, want = ({(r.treatment, r.taxon): r.percent for r in x.collect()} for x in outs)
    assert got.keys() == want.keys() and len(got) > 2
    assert all(got[k] == pytest.approx(want[k]) for k in got)


@pytest.mark.parametrize("name", ["topn_other_composition", "average_composition"])
def test_compositions_count_samples_without_making_cells(spark, name):
    plan = plan_of(tables.Q[name](spark, "/root/testdata/sf0.001"))
    assert "HashAggregate(keys=[l_partkey" in plan
    assert not re.search(r"keys=\[l_partkey[^]]*\], functions=\[\]", plan)  # cells grouped for the names of their samples only


def test_compositions_count_the_samples_given(spark):
    rel = spark.createDataFrame([("x", "s1", 0.5), ("y", "s1", 0.5), ("x", "s3", 1.0)], "taxon string, sample_id string, rel double")
    meta = spark.createDataFrame([("s1", "a"), ("s2", "a"), ("s3", "b"), ("s4", None)], "sample_id string, t string")
    found = rel.select("sample_id")
    for mode in ("average", "per_treatment"):
        outs = [{tuple(r) for r in report.composition(rel, meta, "t", n=1, mode=mode, samples=x).collect()} for x in (None, found, found.union(found))]
        assert outs[0] == outs[1] == outs[2]
    twice = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("s4",), (None,)], "sample_id string")
    got = {r.taxon: r.percent for r in report.composition(rel, meta, "t", n=2, samples=twice).collect()}
    assert got == pytest.approx({"x": 100 * 0.625 / 0.75, "y": 100 * 0.125 / 0.75})
