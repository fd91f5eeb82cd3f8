"""Files of each format, and the pipeline from reads to published tables."""

import gzip
import json
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from taxaflow.operators import reads, report
from taxaflow.plans import config, pipeline
from taxaflow.sources import fastq, sinks, text
from taxaflow.streaming import counts


def write(path, content):
    path.write_text(content)
    return str(path)


@pytest.mark.parametrize("split", [64 << 20, 50, 7])
def test_fastq_in_ranges(spark, tmp_path, split):
    rng = random.Random(1)
    body, want = "", []
    for i in range(40):
        n = rng.randint(1, 30)
        seq, qual = "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+I5A") for _ in range(n))
        body += f"@r{i} 1:N:0:ACGT{i}\n{seq}\n+\n{qual}\n"
        want.append((f"r{i}", seq, qual, f"ACGT{i}"))
    got = fastq.read_fastq(spark, write(tmp_path / "x.fq", body), split)
    assert sorted(map(tuple, got.select("read_id", "seq", "qual", "barcode").collect())) == sorted(want)
    assert fastq.sniff(got, 0) == "sequence" and fastq.sniff(got, 99) == "barcode"
    again = fastq.read_fastq_text(spark, str(tmp_path / "x.fq"))
    assert sorted(map(tuple, again.select("read_id", "seq", "qual", "barcode").collect())) == sorted(want)


def blocked(raw, rng, last=True):
    """Blocked gzip: members of at most 2^16 bytes with their length in an extra field, and an empty one at the end."""
    out, at = b"", 0
    while at < len(raw):
        n = rng.randint(1, 300)
        out += one_block(raw[at : at + n])
        at += n
    return out + (one_block(b"") if last else b"")


def one_block(data):
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 6) + b"BC\x02\0" + struct.pack("<H", 18 + len(body) + 8 - 1)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def fastq_body(rng, n):
    body, want = "", []
    for i in range(n):
        k = rng.randint(1, 30)
        seq, qual = "".join(rng.choice("ACGT") for _ in range(k)), "".join(rng.choice("@+I5A") for _ in range(k))
        body += f"@r{i} 1:N:0:ACGT{i}\n{seq}\n+\n{qual}\n"
        want.append((f"r{i}", seq, qual, f"ACGT{i}"))
    return body, want


@pytest.mark.parametrize("kind", ["plain", "blocks", "gzip", "members", "crlf"])
@pytest.mark.parametrize("split", [1 << 20, 400, 61, 7])
def test_ranges_have_every_record_once(tmp_path, kind, split):
    rng = random.Random(split)
    body, want = fastq_body(rng, 150)
    raw = body.replace("\n", "\r\n").encode() if kind == "crlf" else body.encode()
    raw = {"blocks": lambda: blocked(raw, rng), "gzip": lambda: gzip.compress(raw), "members": lambda: gzip.compress(raw[:999]) + gzip.compress(raw[999:])}.get(kind, lambda: raw)()
    (tmp_path / "x.fq").write_bytes(raw)
    reader = fastq.FastqReader({"path": f"file://{tmp_path}/x.fq", "splitBytes": split})
    parts = reader.partitions()
    got = [r for p in parts for r in reader.read(p)]
    assert [(r[0], r[2], r[3], r[4]) for r in got] == want and [r[5] for r in got] == sorted({r[5] for r in got})
    assert (len(parts) > 1) == (kind not in ("gzip", "members") and split < len(raw))


def test_blocked_gzip_by_several_tasks(spark, tmp_path):
    rng = random.Random(5)
    body, want = fastq_body(rng, 400)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.fq.gz").write_bytes(blocked(body.encode(), rng, last=False))
    (tmp_path / "d" / ".hidden").write_bytes(b"x")
    for path in (str(tmp_path / "d"), f"file://{tmp_path}/d/*.gz", str(tmp_path / "d" / "a.fq.gz")):
        got = fastq.read_fastq(spark, path, 3000)
        assert sorted(map(tuple, got.select("read_id", "seq", "qual", "barcode").collect())) == sorted(want)
    assert got.rdd.getNumPartitions() > 3
    with pytest.raises(Exception):
        fastq.read_fastq(spark, str(tmp_path / "none.fq")).count()


def test_text_lines_of_several_splits(spark, tmp_path):
    rng = random.Random(6)
    body, want = fastq_body(rng, 300)
    long = f"@long {'h' * 1_200_000}:BC\nACGT\n+\nIIII\n"
    (tmp_path / "a.fq").write_text(body + long)
    (tmp_path / "b.fq.gz").write_bytes(gzip.compress(body.replace("@r", "@g").encode()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        got = fastq.read_fastq_text(spark, str(tmp_path)).select("read_id", "seq", "qual", "barcode", F.length("header").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(tuple(r)[:4] for r in got) == sorted([*want, *(("g" + w[0][1:], *w[1:]) for w in want), ("long", "ACGT", "IIII", "BC")])
    assert max(r.n for r in got) == len("long :BC") + 1_200_000


def test_fasta(spark, tmp_path):
    got = text.read_fasta(spark, write(tmp_path / "x.fa", ">a one two\nACG\nT\n>b;size=4;\nGG\n"))
    assert [(r.id, r.desc, r.seq) for r in got.orderBy("ord").collect()] == [("a", "one two", "ACGT"), ("b;size=4;", "", "GG")]
    assert got.select(text.header_size(F.col("id"))).orderBy("ord").collect()[1][0] == 4


def test_map(spark, tmp_path):
    got = text.read_map(spark, write(tmp_path / "m.tsv", "#SampleID\tBarcodeSequence\tSoil\r\ns1\tACGT\t3\r\n\r\ns2\tGGTT\t\r\n"))
    assert [(r.sample_id, r.barcode, r.Soil) for r in got.orderBy("sample_id").collect()][0] == ("s1", "ACGT", "3") and got.count() == 2
    with pytest.raises(ValueError):
        text.read_map(spark, write(tmp_path / "bad.tsv", "a\tb\n1\t2\n"))


def test_feature_table(spark, tmp_path):
    p = write(tmp_path / "t.tsv", "# Constructed from biom file\n#OTU ID\ts1\ts2\ttaxonomy\nOtu1\t3.0\t0\td__A;k__B\nOtu2\t0\t4\tk__Unassigned\n")
    assert sorted(map(tuple, text.read_feature_table(spark, p).collect())) == [("Otu1", "s1", 3.0), ("Otu2", "s2", 4.0)]
    assert {r.tu_id: r.taxonomy for r in text.read_unit_metadata(spark, p).collect()}["Otu1"] == "d__A;k__B"


def test_biom_json_round_trip(spark, tmp_path):
    ft = spark.createDataFrame([("a", "s", 2), ("b", "t", 5)], "tu_id string, sample_id string, n long")
    p = write(tmp_path / "b.json", text.write_biom_json(ft).first()[0])
    assert sorted(map(tuple, text.read_biom_json(spark, p)[0].collect())) == [("a", "s", 2.0), ("b", "t", 5.0)]


@pytest.mark.parametrize("process", ["taxonomy", "naive", "sc_separated"])
def test_biom_written_by_many_tasks(spark, tmp_path, process):
    rows = [(f'u"{i % 700}\\', f"s{i % 11}é", float(i % 5) + (0.25 if i % 3 else 0)) for i in range(700 * 11)]
    ft = spark.createDataFrame(rows, "tu_id string, sample_id string, n double").dropDuplicates(["tu_id", "sample_id"]).repartition(5)
    meta = spark.createDataFrame([('u"1\\', "d__A; k__B"), ('u"1\\', "d__A; k__B"), ('u"2\\', None)], "tu_id string, taxonomy string")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        text.write_biom(ft, str(tmp_path / "b"), meta, process)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "b").glob("part-*"))) > 1
    sinks.join_parts(spark, str(tmp_path / "b"), str(tmp_path / "b.biom"))
    doc = json.loads((tmp_path / "b.biom").read_text())
    assert doc["shape"] == [700, 11] and len(doc["data"]) == ft.count() and [r["id"] for r in doc["rows"]] == sorted(r["id"] for r in doc["rows"])
    about = {r["id"]: r["metadata"] for r in doc["rows"]}
    assert about['u"1\\'] == {"taxonomy": "d__A; k__B" if process == "naive" else ["d__A", "k__B"]} and about['u"3\\'] is None
    want = sorted(map(tuple, ft.collect()))
    for path in ("b", "b.biom"):
        got, units = text.read_biom(spark, str(tmp_path / path))
        assert sorted(map(tuple, got.collect())) == want and units.count() == 700
    assert sorted((doc["rows"][int(i)]["id"], doc["columns"][int(j)]["id"], v) for i, j, v in doc["data"]) == want
    with pytest.raises(ValueError):
        text.write_biom(ft, str(tmp_path / "c"), meta, "other")


def test_empty_biom(spark, tmp_path):
    text.write_biom(spark.createDataFrame([], "tu_id string, sample_id string, n double"), str(tmp_path / "e"))
    assert text.read_biom(spark, str(tmp_path / "e"))[0].count() == 0


def test_cache_versions(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert text.load_cache(spark, path).count() == 0
    first = spark.createDataFrame([("1", ["d__A"])], "taxid string, lineage array<string>")
    wanted = spark.createDataFrame([("1",), ("2",)], "taxid string")
    text.store_cache(first, path)
    reader = text.load_cache(spark, path)
    for i in range(3):
        known, cache = text.through_cache(text.load_cache(spark, path), wanted, lambda ids: ids.withColumn("lineage", F.array(F.concat(F.lit("d__"), "taxid"))))
        text.store_cache(cache, path)
        if i == 0:
            assert reader.count() == 1  # what was being read is still there
    (tmp_path / "cache" / "v-0000000099").mkdir()  # a writer that died
    assert sorted(r.taxid for r in text.load_cache(spark, path).collect()) == ["1", "2"]
    assert len(list((tmp_path / "cache").glob("v-*/_SUCCESS"))) == 2


def test_hits(spark, tmp_path):
    body = "# BLASTN 2\n# Query: Otu1;size=5;\n# Fields: query id, subject id, % identity, alignment length, mismatches, evalue, bit score, subject tax ids, subject title, % query coverage per subject\n# 1 hits found\nOtu1\tgb|A|\t99.5\t100\t1\t1e-5\t180\t7;8\ttitle x\t100\n# BLASTN 2\n# Query: Otu2;size=3;\n# 0 hits found\nOtu1\tshort\n"
    hits, queries = text.read_hits(spark, write(tmp_path / "h.txt", body))
    r = hits.collect()
    assert len(r) == 1 and r[0].staxids == ["7", "8"] and r[0].bitscore == 180.0
    assert {(q.qseqid, q.size) for q in queries.collect()} == {("Otu1", 5), ("Otu2", 3)}
    assert text.fields_of("# Fields: query id, bit score") == ["qseqid", "bitscore"]


def test_hits_by_their_header(spark, tmp_path):
    body = "# Query: q\n# Fields: bit score, query id, extra\r\n12.5\tq\tx\n# Fields: bit score, query id, extra\n8\tq\ty\n"
    hits, _ = text.read_hits(spark, write(tmp_path / "h.txt", body))
    assert sorted(tuple(r)[:3] for r in hits.collect()) == [(8.0, "q", "y"), (12.5, "q", "x")] and hits.columns == ["bitscore", "qseqid", "extra", "hit_ord"]
    with pytest.raises(ValueError):
        text.read_hits(spark, write(tmp_path / "two.txt", body + "# Fields: query id, bit score\n"))


def test_taxonomy_files(spark, tmp_path):
    xml = "<TaxaSet><Taxon><TaxId>5</TaxId><ScientificName>G a</ScientificName><Rank>genus</Rank><ParentTaxId>3</ParentTaxId><LineageEx><Taxon><TaxId>2</TaxId><ScientificName>Bacteria</ScientificName><Rank>domain</Rank></Taxon><Taxon><TaxId>3</TaxId><ScientificName>P</ScientificName><Rank>phylum</Rank></Taxon></LineageEx></Taxon></TaxaSet>"
    got = {r.taxid: (r.parent, r.rank) for r in text.read_taxonomy_xml(spark, write(tmp_path / "t.xml", xml)).collect()}
    assert got["5"] == ("3", "genus") and got["3"] == ("2", "phylum")
    assert tuple(text.read_merged(spark, write(tmp_path / "m.dmp", "1\t|\t2\t|\n")).first()) == ("1", "2")
    assert [r.id for r in text.read_list(spark, write(tmp_path / "l.txt", "a\tx\n\nb\n")).collect()] == ["a", "b"]
    assert [tuple(r) for r in text.read_pairs(spark, write(tmp_path / "p.tsv", "soil\tvalue\ns1\t2.5\ns2\tbad\n")).collect()] == [("s1", 2.5)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 2.0, ["x", "y"])], "id string, v double, l array<string>")
    sinks.write_tsv(df, str(tmp_path / "o"))
    assert spark.read.csv(str(tmp_path / "o"), sep="\t", header=True).first().asDict() == {"id": "a", "v": "2", "l": "x,y"}


def test_params(tmp_path):
    p = config.read_params(write(tmp_path / "p.csv", "max_ee,0.5\nalgorithm,UNOISE3\nidentity,DEFAULT\n"))
    assert (p.max_ee, p.identity, p.smallest) == (0.5, 0.97, 8)
    for bad in (["strategy", "2"], ["mismatches", "9"], ["nonsense", "1"], ["email", "x"]):
        with pytest.raises(ValueError):
            config.parse_rows([bad])
    assert config.length_range("", 101, 25) == [1, 26, 51, 76] and config.table_operation(normalize=True) == "normalize"
    with pytest.raises(ValueError):
        config.table_operation(1.0, 2.0)


@pytest.mark.parametrize("strategy", [1, 2, 3])
def test_pipeline(spark, strategy):
    rng = random.Random(4)
    base = ["".join(rng.choice("ACGT") for _ in range(40)) for _ in range(3)]
    rows = [(f"r{i}", base[i % 3], "I" * 40, "ACGT" if i % 2 else "TTTT") for i in range(60)] + [("bad", base[0], "!" * 40, "ACGT"), ("lost", base[0], "I" * 40, "GGGG")]
    raw = spark.createDataFrame(rows, "read_id string, seq string, qual string, barcode string")
    smap = spark.createDataFrame([("s1", "ACGT", "g1"), ("s2", "TTTT", "g2")], "sample_id string, barcode string, soil string")
    own, ee = pipeline.demux(pipeline.preprocess(raw, smap, 1), smap, [20, 40])
    assert own.count() == 61 and {r.length: r.n_reads for r in ee.collect()} == {20: 61, 40: 61}
    p = config.Params(length=40, strategy=strategy, group_columns=["soil"], known="x")
    known = spark.createDataFrame([("K1", base[0], 1)], "id string, seq string, ord long")
    units = pipeline.unit_table(own, p, sample_map=smap, known=known)
    assert units.table.agg(F.sum("n")).first()[0] == 61 and units.seqs.count() == 3
    tax = units.seqs.select(F.col("id").alias("qseqid"), F.lit("d__A;k__B;p__C").alias("taxonomy"), F.lit(1.0).alias("per_id"), F.lit(1.0).alias("per_qcov"))
    out = pipeline.publish(units.table, tax, seqs=units.seqs, domains=True)
    assert out["raw_L2"].agg(F.sum("n")).first()[0] == 61 and out["detailed"].count() == 3


def test_streaming_counts(spark, tmp_path):
    from datetime import datetime

    rows = [("a", "A", "I", "ACGT", datetime(2024, 1, 1, 0, 1)), ("b", "A", "I", "ACGT", datetime(2024, 1, 1, 0, 2)), ("z", "A", "I", "ACGT", datetime(2024, 1, 2))]
    spark.createDataFrame(rows, counts.SCHEMA).write.parquet(str(tmp_path / "in"))
    smap = spark.createDataFrame([("s1", "ACGT")], "sample_id string, barcode string")
    q = counts.to_folder(counts.counts_by_sample(counts.read_stream(spark, str(tmp_path / "in")), smap), str(tmp_path / "out"), str(tmp_path / "c"))
    q.awaitTermination(120)
    assert [r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]


def test_group_samples(spark):
    smap = spark.createDataFrame([("s2", "g"), ("s1", "g"), ("s3", None)], "sample_id string, soil string")
    assert [tuple(r) for r in reads.samples_of_groups(smap, "soil").collect()] == [("g", "s1,s2")]


def test_numbers_in_general_form(spark):
    values = [0.1, 123456789.0, 1e-5, 100000.0, 999999.5, 0.000123456789, -2.5, 0.0, 1e300, None, float("nan"), float("-inf"), 12.0, 1200.0]
    got = spark.createDataFrame([(values,)], "v array<double>").select(report.rendered(F.col("v")).alias("s")).first().s
    assert got == ",".join("nan" if v is None else f"{v:g}" for v in values)


def test_the_cache_takes_what_it_lacked(spark):
    cache = spark.createDataFrame([("1", ["a"]), ("9", ["z"])], "taxid string, lineage array<string>")
    wanted = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "taxid string")
    asked = []

    def resolve(missing):
        asked.extend(sorted(r.taxid for r in missing.collect()))
        return missing.where("taxid = '2'").withColumn("lineage", F.array(F.lit("b")))

    got, after = text.through_cache(cache, wanted, resolve)
    assert asked == ["2", "3"] and sorted((r.taxid, r.lineage[0]) for r in got.collect()) == [("1", "a"), ("2", "b")]
    assert sorted(r.taxid for r in after.collect()) == ["1", "2", "9"]
