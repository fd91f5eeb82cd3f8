"""Operators on small fixtures and against plain Python."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from taxaflow.functions import ordering, probability, sequence
from taxaflow.operators import barcodes, categorize, cluster, derep, hits, mapping, report, stats, table, taxonomy, tree


def table_of(spark, rows):
    return spark.createDataFrame(rows, "tu_id string, sample_id string, n long")


def test_normalize_sums_to_one_and_keeps_zero_samples(spark):
    ft = table_of(spark, [("a", "s", 1), ("b", "s", 3), ("a", "z", 0)])
    got = {(r.tu_id, r.sample_id): r.rel for r in table.normalize(ft).collect()}
    assert got == {("a", "s"): 0.25, ("b", "s"): 0.75, ("a", "z"): 0.0}


def test_collapse_keeps_totals(spark):
    ft = table_of(spark, [("a", "s", 1), ("b", "s", 3), ("c", "t", 5), ("x", "t", 2)])
    lin = spark.createDataFrame([("a", ["d", "k", "p"]), ("b", ["d", "k", "q"]), ("c", ["d", "l"])], "tu_id string, lineage array<string>")
    for level in (1, 2, 3):
        assert table.collapse(ft, lin, level).agg(F.sum("n")).first()[0] == 11
    assert ("k__Unassigned", "t", 2) in {tuple(r) for r in table.collapse(ft, lin, 2).collect()}


def test_wide_and_long_are_inverse(spark):
    ft = table_of(spark, [("a", "s", 1), ("b", "t", 3)])
    assert sorted(map(tuple, table.long(table.wide(ft, ["s", "t"]), ["s", "t"]).collect())) == [("a", "s", 1), ("b", "t", 3)]


def test_rint_is_half_even_and_lists_zero_others(spark):
    ft = table_of(spark, [("a", "s", 1), ("b", "s", 5)])
    assert {r.tu_id: r.n for r in table.multiply(ft, 0.5).collect()} == {"a": 0.0, "b": 2.0}
    d = spark.createDataFrame([("b", 2.0)], "tu_id string, divisor double")
    assert {r.tu_id: r.n for r in table.divide_by_list(ft, d).collect()} == {"a": 0.0, "b": 2.5}
    with pytest.raises(ValueError):
        table.divide_by_list(ft, spark.createDataFrame([("q", 2.0)], "tu_id string, divisor double"), check=True)


def test_raw_counts_guard(spark):
    table.check_raw_counts(table_of(spark, [("a", "s", 4)]))
    for rows in ([("a", "s", 0.25), ("b", "s", 0.75)], [("a", "s", -1.0)]):
        with pytest.raises(ValueError):
            table.check_raw_counts(spark.createDataFrame(rows, "tu_id string, sample_id string, n double"))


def test_row_numbers_and_bh_match_plain_python(spark):
    rng = random.Random(1)
    p = [(i, rng.choice([0.001, 0.01, 0.2, 0.5, rng.random()])) for i in range(300)] + [(300, None), (301, float("nan"))]
    df = spark.createDataFrame(p, "id long, p double").repartition(7)
    got = {r.id: r.p_adj for r in ordering.adjust_bh(df).collect()}
    real = sorted((x for x in p if x[1] is not None and x[1] == x[1]), key=lambda x: x[1])
    low, want = 1.0, {}
    for k in range(len(real), 0, -1):
        low = min(low, real[k - 1][1] * len(real) / k)
        want[real[k - 1][0]] = low
    assert got[300] is None and got[301] is None
    assert all(abs(got[i] - w) < 1e-12 for i, w in want.items()) and len(got) == 302
    numbered = ordering.row_number(df.where("p is not null"), [F.asc("p"), F.asc("id")], "i").orderBy("i").collect()
    assert [r.i for r in numbered] == list(range(1, 302))


def test_tail_probabilities():
    assert abs(probability.two_sided_t(2.228139, 10) - 0.05) < 1e-6
    assert probability.two_sided_t(math.inf, 3) == 0.0 and probability.two_sided_t(1.0, 0) is None


def test_sequence_expressions(spark):
    r = spark.range(1).select(
        sequence.expected_errors(F.lit("+5?")).alias("ee"), sequence.hamming(F.lit("ACGT"), F.lit("AGGTTT")).alias("h"), sequence.has_run(F.lit("A" * 20)).alias("run"),
        sequence.only_ascii(F.lit("aéb")).alias("a"), sequence.reverse_complement(F.lit("AACG")).alias("rc"), sequence.count_char(F.lit("ANNA"), "N").alias("n"),
        F.size(sequence.kmers(F.lit("AC"), 3)).alias("k"), sequence.hamming(F.lit("ACGT"), F.lit("AC")).alias("short")).first()
    assert abs(r.ee - (0.1 + 0.01 + 0.001)) < 1e-12 and (r.h, r.run, r.a, r.rc, r.n, r.k, r.short) == (1, True, "a?b", "CGTT", 2, 0, 2)


def test_rescue_is_unique_nearest(spark):
    rng = random.Random(3)
    known = list({"".join(rng.choice("ACGT") for _ in range(6)) for _ in range(12)})
    seen = list({"".join(rng.choice("ACGT") for _ in range(6)) for _ in range(300)} | set(known))
    smap = spark.createDataFrame([(f"s{i}", b) for i, b in enumerate(known)], "sample_id string, barcode string")
    counts = spark.createDataFrame([(b, 1) for b in seen], "barcode string, n long")
    found = barcodes.collisions(counts, smap, 2)
    got = {r.barcode: r.bc for r in barcodes.rescue_pairs(found, counts, [1, 2], keep_larger=True).collect()}
    want = {}
    for b in seen:
        d = sorted((sum(x != y for x, y in zip(k, b)), k) for k in known)
        if 0 < d[0][0] <= 2 and d[0][0] < d[1][0]:
            want[b] = d[0][1]
    assert got == want
    assert {r.barcode for r in found.where("kind = 'bc'").collect()} == set(known)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_near_barcodes_are_all_pairs_within_the_distance(spark, most):
    rng = random.Random(most)
    make = lambda: "".join(rng.choice("AC") for _ in range(rng.randint(1, 7)))
    known, seen = {make() for _ in range(25)}, {make() for _ in range(60)} | {""}
    smap = spark.createDataFrame([(k, k) for k in known] + [("none", ""), ("null", None)], "sample_id string, barcode string")
    got = barcodes.near_pairs(spark.createDataFrame([(b, 1) for b in seen], "barcode string, n long"), smap, most)
    distance = lambda a, b: sum(i >= len(b) or a[i] != b[i] for i in range(len(a)))
    assert sorted((r.barcode, r.bc, r.d) for r in got.collect()) == sorted((b, k, distance(k, b)) for b in seen for k in known if distance(k, b) <= most)
    assert barcodes.near_pairs(spark.createDataFrame([("A", 1)], "barcode string, n long"), smap.limit(0), most).count() == 0


def test_expected_errors_of_odd_strings(spark):
    rows = spark.createDataFrame([("",), (None,), ("!",), ("é",)], "q string").select(sequence.expected_errors(F.col("q")).alias("e")).collect()
    assert [r.e for r in rows] == [0.0, None, 1.0, pytest.approx(10 ** (-(ord("é") - 33) / 10))]


def test_phage_hits_reject_more(spark):
    def final(*hits_, phix=(9,)):
        rows = [("q", f"a{i}", float(b), [str(t)], "t", i) for i, (t, b) in enumerate(hits_)]
        h = spark.createDataFrame(rows, "qseqid string, sseqid string, bitscore double, staxids array<string>, stitle string, hit_ord long")
        known = spark.createDataFrame([(1, "K"), (9, "R"), (8, "R")], "taxid long, class string")
        return categorize.keep_reject(h, spark.createDataFrame([("q", 1)], "qseqid string, size long"), known, phix).first().final

    assert final((1, 50), (9, 40), (5, 60)) == "R" and final((1, 50), (9, 40), (5, 60), phix=()) == "K"  # phage, and no better than an unknown
    assert final((1, 70), (9, 40), (9, 40), (9, 40), (5, 60)) == "R" and final((1, 70), (9, 40), (5, 60)) == "K"  # three phage hits
    assert final((1, 50), (8, 40), (5, 60)) == "K"


def test_merge_identical_keeps_first_seen_order(spark):
    s = spark.createDataFrame([("b", "acg", 2), ("a", "ACG", 1), ("c", "CGT", 3)], "id string, seq string, ord long")
    assert sorted((r.id, r.seq) for r in derep.merge_identical(s).collect()) == [("a,b", "ACG"), ("c", "CGT")]


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def by_identity(share):
    return lambda s, n, c, m: plain_distance(s, c) <= math.floor((1 - share) * max(len(s), len(c)) + 1e-9)


def by_skew(alpha):
    return lambda s, n, c, m: m >= 2 * n and plain_distance(s, c) <= math.floor((math.log2(m / n) - 1) / alpha + 1e-9)


def serial_pass(sizes, joins):
    centres, out = [], {}
    for s, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        to = next((c for c, m in centres if joins(s, n, c, m)), None)
        if to is None:
            centres.append((s, n))
        out[s] = to or s
    return out


def noisy(rng, n_base, n, length, edits):
    base = ["".join(rng.choice("ACGT") for _ in range(length)) for _ in range(n_base)]
    sizes = {}
    for _ in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, edits)):
            i = rng.randrange(len(s))
            s[i : i + 1] = rng.choice([["A"], ["C"], ["G"], ["T"], [], ["A", "G"]])
        sizes["".join(s)] = rng.choice([1, 1, 1, 2, 5, rng.randint(1, 60)])
    return sizes


@pytest.mark.parametrize("options", [{}, {"tail": 0}, {"least_pairs": 30, "pairs_per_sequence": 1}])
@pytest.mark.parametrize("rule,joins", [(cluster.ByIdentity(0.8), by_identity(0.8)), (cluster.BySkew(1.0), by_skew(1.0)), (cluster.ByIdentity(1.0), by_identity(1.0))])
def test_greedy_equals_the_serial_pass(spark, rule, joins, options):
    sizes = noisy(random.Random(7), 6, 60, 14, 4)
    found = spark.createDataFrame(list(sizes.items()), "seq string, size long")
    got = cluster.greedy(found, rule, **options).collect()
    assert {r.seq: r.centroid for r in got} == serial_pass(sizes, joins)
    assert [r.seq for r in sorted(got, key=lambda r: r.ord)] == sorted(sizes, key=lambda s: (-sizes[s], s))
    centres = [r.centroid for r in sorted(got, key=lambda r: r.ord) if r.ord == r.centroid_ord]
    assert {r.tu_id: r.centroid for r in got} == {f"Otu{i}": c for i, c in enumerate(centres, 1)}


def test_greedy_of_lax_thresholds_odd_and_no_sequences(spark):
    sizes = {"A": 64, "CC": 1, "GGGG": 2, "": 3, "TTTTTTTTT": 1, "AAAA": 30}
    found = spark.createDataFrame(list(sizes.items()), "seq string, size long")
    assert {r.seq: r.centroid for r in cluster.denoise(found, alpha=0.5, least=1).collect()} == serial_pass(sizes, by_skew(0.5))
    assert {r.seq: r.centroid for r in cluster.cluster(found, 0.6).collect()} == serial_pass(sizes, by_identity(0.6))
    assert cluster.cluster(found.where("false")).count() == 0


def test_groups_are_clustered_on_their_own_in_one_plan(spark):
    rng = random.Random(3)
    groups = {g: noisy(rng, 3, 25, 12, 3) for g in ("x", "y", "z")}
    found = spark.createDataFrame([(g, s, n) for g, sizes in groups.items() for s, n in sizes.items()], "group string, seq string, size long")
    got = cluster.cluster(found, 0.8, by=["group"]).collect()
    assert {(r.group, r.seq): r.centroid for r in got} == {(g, s): c for g, sizes in groups.items() for s, c in serial_pass(sizes, by_identity(0.8)).items()}
    assert {(r.group, r.seq): r.ord for r in got} == {(g, s): i for g, sizes in groups.items() for i, s in enumerate(sorted(sizes, key=lambda s: (-sizes[s], s)), 1)}
    seen = cluster.centroids(cluster.cluster(found, 0.8, by=["group"]), ["group"]).orderBy("group", "ord").collect()
    assert [r.id for r in seen if r.group == "y"] == [f"Otu{i}" for i in range(1, 1 + sum(r.group == "y" for r in seen))]


def test_chains_and_large_groups(spark):
    """A chain of near neighbours, each near the next only, and many copies of one text."""
    chain = ["A" * i + "C" * (40 - i) for i in range(41)]
    copies = ["G" * 20 + "".join(x) + "T" * 17 for x in itertools.product("ACGT", repeat=3)]
    sizes = dict.fromkeys(chain + copies, 1)
    found = spark.createDataFrame(list(sizes.items()), "seq string, size long")
    for options in ({"tail": 0}, {"least_pairs": 500, "pairs_per_sequence": 1}):
        assert {r.seq: r.centroid for r in cluster.cluster(found, 0.97, **options).collect()} == serial_pass(sizes, by_identity(0.97))


def test_mapping_finds_the_best_unit(spark):
    rng = random.Random(9)
    units = [(f"u{i}", "".join(rng.choice("ACGT") for _ in range(rng.randint(18, 24))), i) for i in range(8)]
    seqs = set()
    for _ in range(80):
        s = list(rng.choice(units)[1])
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(s))
            s[i : i + 1] = rng.choice([[], ["A"], ["C", "G"]])
        seqs.add("".join(s))
    got = {r.seq: (r.tu_id, round(r.identity, 9)) for r in mapping.map_sequences(spark.createDataFrame([(s,) for s in seqs], "seq string"), spark.createDataFrame(units, "id string, seq string, ord long"), 0.85).collect()}
    want = {}
    for s in seqs:
        best = max(((round(1 - plain_distance(s, u) / max(len(s), len(u)), 9), -o, i) for i, u, o in units))
        if best[0] >= 0.85 - 1e-9:
            want[s] = (best[2], best[0])
    assert got == want


LCA = [
    ([["d__A", "k__B", "p__C", "c__Z"], ["d__A", "k__B", "p__D", "c__Z"]], "d__A;k__B;c__Z", "d__A;k__B"),
    ([["d__A", "k__B", "p__unclassified_B"]], "d__A;k__B;p__unclassified_B", "d__A;k__B;p__unclassified_B"),
    ([["d__B"], ["d__A"]], "d__A_OR_d__B", "d__A_OR_d__B"),
    ([["d__A", "k__B", "f__E", "g__X"], ["d__A", "k__B", "f__E"], ["d__A", "k__B"]], "d__A;k__B", "d__A;k__B"),
    ([], "k__Unassigned", "k__Unassigned"),
]


@pytest.mark.parametrize("lines,fold,strict", LCA)
def test_lca(spark, lines, fold, strict):
    df = spark.createDataFrame([(lines,)], "l array<array<string>>")
    assert df.select(taxonomy.name_lca(F.col("l"))).first()[0] == fold
    assert df.select(taxonomy.name_lca(F.col("l"), "strict_prefix")).first()[0] == strict


def test_strict_lca_ignores_order(spark):
    lines = [["d", "k", "p"], ["d", "k", "q"], ["d", "l", "p"]]
    got = {spark.createDataFrame([(list(x),)], "l array<array<string>>").select(taxonomy.name_lca(F.col("l"), "strict")).first()[0] for x in itertools.permutations(lines)}
    assert got == {"d"}


def test_lineages(spark):
    nodes = spark.createDataFrame([("1", None, "no rank", "root"), ("2", "1", "domain", "Bacteria"), ("3", "2", "phylum", "P x"), ("4", "3", "clade", "c"), ("5", "4", "genus", "G='a'")], "taxid string, parent string, rank string, name string")
    merged = spark.createDataFrame([("9", "5")], "old string, new string")
    got = {r.taxid: ";".join(r.lineage) for r in taxonomy.lineages(nodes, merged).collect()}
    want = "d__Bacteria;k__Unassigned;p__P_x;c__unclassified_P x;o__unclassified_P x;f__unclassified_P x;g__G.a;s__unclassified_G='a'"
    assert got["5"].split(";")[:3] == want.split(";")[:3] and got["5"].split(";")[6] == "g__G.a" and got["9"] == got["5"]


HIT = "qseqid string, sseqid string, pident double, mismatch int, bitscore double, staxids array<string>, stitle string, qcovs double, hit_ord long"


def test_top_hits_keep_queries_without_hits(spark):
    h = spark.createDataFrame([("q", "a", 99.0, 0, 50.0, ["1"], "t", 90.0, 1), ("q", "b", 98.0, 0, 50.0, ["1"], "t", 91.0, 2), ("q", "c", 97.0, 0, 50.0, ["2"], "t", 92.0, 3), ("q", "d", 97.0, 0, 40.0, ["3"], "t", 92.0, 4), ("q", "e", 97.0, 0, 60.0, ["3", "4"], "t", 92.0, 5)], HIT)
    q = spark.createDataFrame([("q",), ("none",)], "qseqid string")
    top = hits.top_hits(h, q)
    assert {(r.qseqid, r.taxid, r.pident, r.n_hits) for r in top.collect()} == {("q", "1", 99.0, 2), ("q", "2", 97.0, 1), ("none", None, None, None)}
    assert {r.qseqid: r.value for r in hits.render_summary(hits.top_hit_summary(top)).collect()} == {"q": "[(50.0|99.0|1|1|90.0) (50.0|97.0|2|1|92.0)]", "none": "[]"}


@pytest.mark.parametrize("line,want", [("# Query: Asv1 1343563", ("Asv1", 1343563)), ("# Query: Otu2;size=17;", ("Otu2", 17)), ("# Query: c1 len=9", ("c1", 9)), ("# Query: NODE_3_length_55_cov_2", ("NODE_3_length_55_cov_2", 55))])
def test_query_lines(spark, line, want):
    assert tuple(spark.range(1).select(hits.parse_query_line(F.lit(line)).alias("q")).select("q.*").first()) == want


@pytest.mark.parametrize("code,scores,want", [
    ("EKRU", dict(bK=1, bR=2), "R"), ("EKRU", dict(bK=2, bR=2, cK=2, cR=1, nK=1, nR=1), "K"), ("KR", dict(bK=2, bR=2, cK=1, cR=1), "R"), ("KR", dict(bK=3, bR=2), "K"),
    ("EU", dict(bE=1, bU=2, cE=1, cU=1), "R"), ("EU", dict(bE=2, bU=2, u_title="x chloroplast"), "R"), ("EU", dict(bE=2, bU=2, u_title="x"), "K"), ("KU", dict(bK=1, bU=2, nK=1, nU=1), "K"),
    ("KU", dict(bK=2, bU=2, nK=1, nU=1), "R"), ("KRU", dict(bK=2, bR=2, cK=9, cR=1), "R"), ("N", {}, "K"), ("U", {}, "R"), ("EKU", {}, "K"), ("ERU", {}, "R"),
])
def test_decisions(spark, code, scores, want):
    names = [f"{k}{c}" for k in "bcn" for c in "EKRU"]
    row = [float(scores[n]) if n in scores else None if n[0] == "b" else 0.0 for n in names] + [scores.get("u_title"), code]
    df = spark.createDataFrame([row], ", ".join([*(f"{n} double" for n in names), "u_title string, initial string"]))
    assert df.select(categorize.decision(F.col("initial"))).first()[0] == want


def test_pairs_match_plain_correlation(spark):
    rng = random.Random(2)
    data = {f"u{i}": [rng.randint(0, 4) for _ in range(7)] for i in range(9)} | {"flat": [1] * 7}
    df = spark.createDataFrame([(u, s, float(v)) for u, x in data.items() for s, v in enumerate(x)], "u string, s int, v double")
    got = {(r.a, r.b): r.rho for r in stats.correlate_units(df, "u", "s", "v", block=4).collect()}

    def ranks(x):
        return [sum(y < v for y in x) + (sum(y == v for y in x) + 1) / 2 for v in x]

    for a, b in itertools.combinations(sorted(data), 2):
        x, y = ranks(data[a]), ranks(data[b])
        mx, my = sum(x) / 7, sum(y) / 7
        sx, sy = (math.sqrt(sum((v - m) ** 2 for v in z)) for z, m in ((x, mx), (y, my)))
        want = sum((p - mx) * (q - my) for p, q in zip(x, y)) / (sx * sy) if sx and sy else 0.0
        assert abs(got[a, b] - want) < 1e-9


def test_blocks_of_far_units_are_not_compared(spark):
    """Units of a few directions: only blocks of near (or opposite) ones meet, and no pair within the thresholds is lost."""
    rng = random.Random(12)
    base = [[rng.random() for _ in range(40)] for _ in range(6)]
    data = {}
    for i in range(96):
        b = base[i % 6]
        sign = -1 if i >= 90 else 1
        data[f"u{i:02}"] = [sign * (x + 0.02 * rng.random()) for x in b]
    data["flat"] = [1.0] * 40
    rows = [(u, f"s{j:02}", v) for u, vs in data.items() for j, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "u string, s string, v double")
    every = {(r.a, r.b): r.rho for r in stats.correlate_units(df, "u", "s", "v").collect()}
    assert len(every) == 97 * 96 // 2 and all(a < b for a, b in every)
    got = {(r.a, r.b): r.rho for r in stats.correlate_units(df, "u", "s", "v", high=0.9, low=-0.9, block=4).collect()}
    assert got.keys() == {k for k, r in every.items() if abs(r) >= 0.9} and all(abs(got[k] - every[k]) < 1e-12 for k in got) and min(got.values()) < 0
    packed = df.groupBy("u").agg(F.transform(F.sort_array(F.collect_list(F.struct("s", "v"))), lambda x: x["v"]).alias("v")).withColumn("_i", F.expr("cast(hash(u) as long)"))
    placed, pairs = stats.block_pairs(packed, 0.9, -0.9, 4, 4)
    n = placed.agg(F.max("_block")).first()[0] + 1
    assert pairs.count() < 0.7 * n * (n + 1) / 2


@pytest.mark.parametrize("seed", [1, 2])
def test_correlation_with_a_column_makes_no_zero_cells(spark, seed):
    rng = random.Random(seed)
    samples = [f"s{i}" for i in range(9)]
    meta = [(s, rng.choice([1.0, 2.0, 2.0, 5.5, None])) for s in samples] + [("elsewhere", 3.0)]
    cells = [(f"u{u}", s, rng.choice([-2, -1, 0, 1, 1, 3])) for u in range(12) for s in samples if rng.random() < 0.6] + [("same", s, 4) for s in samples] + [("zero", samples[0], 0)]
    got = {r.tu_id: r for r in stats.correlate_with_column(spark.createDataFrame(cells, "tu_id string, sample_id string, n long"), spark.createDataFrame(meta, "sample_id string, m double"), "m").collect()}
    known = {s: m for s, m in meta if m is not None and s in samples}

    def ranks(x):
        return [sum(y < v for y in x) + (sum(y == v for y in x) + 1) / 2 for v in x]

    want = {}
    for u in {c[0] for c in cells}:
        own = {c[1]: c[2] for c in cells if c[0] == u}
        x, y = ([own.get(s, 0) for s in known], list(known.values()))
        if len(set(x)) > 1 and len(set(y)) > 1:
            a, b = ranks(x), ranks(y)
            ma, mb = sum(a) / len(a), sum(b) / len(b)
            want[u] = (sum((p - ma) * (q - mb) for p, q in zip(a, b)) / math.sqrt(sum((p - ma) ** 2 for p in a) * sum((q - mb) ** 2 for q in b)), sum(x) / len(x))
    assert got.keys() == want.keys()
    assert all(abs(got[u].rho - rho) < 1e-12 and abs(got[u].average - mean) < 1e-12 and got[u].n == len(known) for u, (rho, mean) in want.items())


def test_composition_sums_to_100(spark):
    rel = spark.createDataFrame([("a", "s1", 0.7), ("b", "s1", 0.2), ("c", "s1", 0.1), ("a", "s2", 0.5), ("c", "s2", 0.5)], "taxon string, sample_id string, rel double")
    meta = spark.createDataFrame([("s1", "x"), ("s2", "y"), ("s3", "x")], "sample_id string, t string")
    for mode in ("average", "per_treatment"):
        out = report.composition(rel, meta, "t", n=1, mode=mode)
        assert all(abs(r[1] - 100) < 1e-9 for r in out.groupBy("treatment").agg(F.sum("percent")).collect())
    assert report.order_composition(out).collect()[-1].taxon == "other"


def test_strict_sequences(spark):
    ft = table_of(spark, [("a", "s", 1)])
    with pytest.raises(ValueError):
        report.add_sequences(ft, spark.createDataFrame([("b", "ACG")], "id string, seq string"))


def test_neighbour_joining_recovers_an_additive_tree():
    import numpy as np

    d = np.array([[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]], float)
    t = tree.neighbour_joining(list("abcde"), d)
    clades = {frozenset(n.leaves()) for n in tree._nodes(t)}
    assert frozenset("ab") in clades or frozenset("cde") in clades
    for name in "abcde":
        r = tree.root_at(tree.neighbour_joining(list("abcde"), d), name)
        assert r.leaves() == list("abcde") and [name] in [c.leaves() for c in r.children]


def test_tips():
    assert tree.find_tip(["Abc1", "x"], "abc") == "Abc1"
    with pytest.raises(ValueError):
        tree.find_tip(["ab", "abc"], "A")


def test_ties_and_groups_are_numbered_in_parts(spark):
    ties = spark.createDataFrame([(f"u{i}", 1.0 if i % 3 else 0.01 + i / 10_000) for i in range(300)], "id string, p double").repartition(7)
    got = {r.id: r.p_adj for r in ordering.adjust_bh(ties).collect()}
    least = [0.01 + i / 10_000 for i in range(0, 300, 3)]
    for k, p in enumerate(least):
        assert abs(got[f"u{3 * k}"] - min(1.0, *(q * 300 / (j + 1) for j, q in enumerate(least) if j >= k))) < 1e-12
    assert all(got[f"u{i}"] == 1.0 for i in range(300) if i % 3)
    found = spark.createDataFrame([(g, f"s{i:03}", i % 4) for g in ("a", None, "b") for i in range(40)], "g string, seq string, size int").repartition(5)
    for g in ("a", None, "b"):
        rows = [r for r in derep.label_in_groups(found, "g").collect() if r.g == g]
        assert [r.seq for r in sorted(rows, key=lambda r: r.ord)] == [r.seq for r in sorted(rows, key=lambda r: (-r.size, r.seq))]
        assert sorted(r.ord for r in rows) == list(range(1, 41)) and all(r.id == f"Uniq{r.ord}" for r in rows)
