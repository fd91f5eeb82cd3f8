"""FASTA, maps, feature tables, hit tables, taxonomies, lists and parameters as DataFrames, from any store Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxaflow.functions.ordering import row_number
from taxaflow.functions.staging import materialize
from taxaflow.operators.hits import parse_query_line
from taxaflow.operators.table import long

#: The ten columns of the hit format, in order.
HIT_COLUMNS = ["qseqid", "sseqid", "pident", "length", "mismatch", "evalue", "bitscore", "staxids", "stitle", "qcovs"]
HIT_TYPES = {"pident": "double", "length": "int", "mismatch": "int", "evalue": "double", "bitscore": "double", "qcovs": "double"}


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, desc, seq, ord) of each record; ord grows in file order."""
    rows = spark.read.option("lineSep", "\n>").text(path).withColumn("ord", F.monotonically_increasing_id())
    record = rows.select("ord", F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "").alias("v")).where(F.trim("v") != "")
    head, body = F.regexp_extract("v", r"^([^\n]*)", 1), F.regexp_replace(F.regexp_replace("v", r"^[^\n]*", ""), r"\s", "")
    return record.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("desc"), body.alias("seq"), "ord")


def header_size(header):
    """The ;size=n; annotation, else a _n suffix."""
    return F.coalesce(F.regexp_extract(header, r"size=(\d+)", 1).try_cast("bigint"), F.regexp_extract(header, r"_(\d+)$", 1).try_cast("bigint"))


def header_sample(header):
    return F.nullif(F.regexp_extract(header, r";sample=([^;]*);", 1), F.lit(""))


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """A sample map: tab-separated with columns #SampleID and BarcodeSequence, others as they are; blank lines are skipped."""
    df = spark.read.csv(path, sep="\t", header=True)
    df = df.toDF(*[c.strip().rstrip("\r") for c in df.columns])
    missing = {"#SampleID", "BarcodeSequence"} - set(df.columns)
    if missing:
        raise ValueError(f"the sample map lacks columns {sorted(missing)}")
    df = df.select(*[F.regexp_replace(F.col(f"`{c}`"), "\r$", "").alias(c) for c in df.columns])
    return df.withColumnsRenamed({"#SampleID": "sample_id", "BarcodeSequence": "barcode"}).where(F.coalesce(F.trim("sample_id"), F.lit("")) != "")


def barcode_fasta(sample_map: DataFrame) -> DataFrame:
    """The map's barcodes as FASTA records; lines that don't begin with a capital letter (so comments) are left out."""
    return sample_map.where(F.col("sample_id").rlike("^[A-Z]")).select(F.concat(F.lit(">"), "sample_id", F.lit("\n"), "barcode").alias("value"))


def _table_lines(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    lines = spark.read.text(path).where(~F.col("value").startswith("# Constructed from biom file") & (F.trim("value") != ""))
    head = lines.where(F.col("value").rlike("^#(OTU|ASV) ?ID|^#OTU|^#ASV")).first()
    if head is None:
        raise ValueError("no header line in the feature table")
    names = head[0].rstrip("\r").split("\t")
    body = lines.where(F.col("value") != head[0]).select(F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("c"))
    return names, body.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)])


#: Columns of a feature table that aren't samples.
EXTRA = ["taxonomy", "Sequence"]


def read_feature_table(spark: SparkSession, path: str, zeros: bool = False) -> DataFrame:
    """A wide table as (tu_id, sample_id, n)."""
    names, table = _table_lines(spark, path)
    samples = [n for n in names[1:] if n not in EXTRA]
    table = table.select(F.col(f"`{names[0]}`").alias("tu_id"), *[F.col(f"`{s}`").cast("double").alias(s) for s in samples])
    return long(table, samples, zeros=zeros)


def read_unit_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(tu_id, taxonomy, Sequence), as far as the table has them."""
    names, table = _table_lines(spark, path)
    return table.select(F.col(f"`{names[0]}`").alias("tu_id"), *[n for n in EXTRA if n in names])


def read_biom_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Counts (tu_id, sample_id, n) and metadata (tu_id, taxonomy array) of sparse BIOM in JSON."""
    schema = "rows array<struct<id:string,metadata:struct<taxonomy:array<string>>>>, columns array<struct<id:string>>, data array<array<double>>"
    b = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("b")).select("b.*")
    cells = b.select("rows", "columns", F.explode("data").alias("x"))
    ft = cells.select(F.get("rows", F.col("x")[0].cast("int"))["id"].alias("tu_id"), F.get("columns", F.col("x")[1].cast("int"))["id"].alias("sample_id"), F.col("x")[2].alias("n"))
    return ft, b.select(F.explode("rows").alias("r")).select(F.col("r.id").alias("tu_id"), F.col("r.metadata.taxonomy").alias("taxonomy"))


def write_biom_json(ft: DataFrame) -> DataFrame:
    """A small table as one JSON document in one row; ``write_biom`` writes any table."""
    units = ft.select("tu_id").distinct().agg(F.array_sort(F.collect_set("tu_id")).alias("u"))
    samples = ft.select("sample_id").distinct().agg(F.array_sort(F.collect_set("sample_id")).alias("s"))
    cells = ft.crossJoin(units).crossJoin(samples).select("u", "s", F.array((F.array_position("u", F.col("tu_id")) - 1).cast("double"), (F.array_position("s", F.col("sample_id")) - 1).cast("double"), F.col("n").cast("double")).alias("x"))
    g = cells.groupBy("u", "s").agg(F.array_sort(F.collect_list("x")).alias("data"))
    rows = F.transform("u", lambda x: F.struct(x.alias("id")))
    return g.select(F.to_json(F.struct(F.lit("Biological Observation Matrix 1.0.0").alias("format"), F.lit("sparse").alias("matrix_type"), rows.alias("rows"), F.transform("s", lambda x: F.struct(x.alias("id"))).alias("columns"), F.array(F.size("u"), F.size("s")).alias("shape"), "data")).alias("value"))


#: How a document begins, what stands between its parts, and its end.
BIOM_HEAD = '{"id":null,"format":"Biological Observation Matrix 1.0.0","type":"OTU table","matrix_type":"sparse","matrix_element_type":"float","shape":[%d,%d],"rows":['
BIOM_COLUMNS, BIOM_DATA, BIOM_END = '],"columns":[', '],"data":[', "]}"


def write_biom(ft: DataFrame, path: str, metadata: DataFrame | None = None, process: str = "taxonomy") -> None:
    """A table (tu_id, sample_id, n) as one sparse BIOM document in JSON, written by many tasks: a row, column or cell on each line.

    The new folder ``path`` holds parts that follow one another by name; ``sinks.join_parts`` makes one file of them.
    Units and samples are numbered in order of their ids, cells go by these numbers. ``metadata`` (tu_id, taxonomy) adds the
    units' taxonomy: split at semicolons (``taxonomy``, ``sc_separated``) or as it is (``naive``).
    """
    if process not in ("taxonomy", "sc_separated", "naive"):
        raise ValueError("process is one of taxonomy, sc_separated and naive")
    spark = ft.sparkSession
    units, samples = (row_number(ft.select(c).distinct(), [F.col(c).asc()], i) for c, i in (("tu_id", "_i"), ("sample_id", "_j")))
    n_units, n_samples = units.count(), samples.count()
    if metadata is None:
        about = units.withColumn("metadata", F.lit("null"))
    else:
        taxonomy = F.col("taxonomy") if process == "naive" else F.transform(F.split("taxonomy", ";"), lambda x: F.trim(x))
        known = metadata.groupBy("tu_id").agg(F.first("taxonomy").alias("taxonomy"))
        about = units.join(known, "tu_id", "left").withColumn("metadata", F.when(F.col("taxonomy").isNotNull(), F.to_json(F.struct(taxonomy.alias("taxonomy")))).otherwise(F.lit("null")))
    quoted = lambda c: F.get_json_object(F.to_json(F.struct(F.array(c).alias("x"))), "$.x")  # noqa: E731  ["..."]
    name = lambda c: F.expr(f"substring({c}, 2, length({c}) - 2)")
    comma = lambda first: F.when(first, F.lit("")).otherwise(F.lit(","))
    item = lambda df, c, i, part, meta: df.withColumn("_q", quoted(F.col(c))).select(F.lit(part).alias("part"), F.col(i).alias("i"), F.lit(0).cast("long").alias("j"), F.concat(comma(F.col(i) == 1), F.lit('{"id":'), name("_q"), F.lit(',"metadata":'), meta, F.lit("}")).alias("value"))
    cells = ft.join(units, "tu_id").join(samples, "sample_id").select("_i", "_j", F.col("n").cast("double").alias("n"))
    least = cells.agg(F.min(F.struct("_i", "_j"))).first()[0] or (0, 0)
    number = F.when(F.col("n") == F.floor("n"), F.floor("n").cast("string")).otherwise(F.col("n").cast("string"))
    text = F.concat(comma((F.col("_i") == least[0]) & (F.col("_j") == least[1])), F.lit("["), (F.col("_i") - 1).cast("string"), F.lit(","), (F.col("_j") - 1).cast("string"), F.lit(","), number, F.lit("]"))
    lines = cells.select(F.lit(5).alias("part"), F.col("_i").alias("i"), F.col("_j").alias("j"), text.alias("value"))
    lines = lines.unionByName(item(about, "tu_id", "_i", 1, F.col("metadata"))).unionByName(item(samples, "sample_id", "_j", 3, F.lit("null")))
    marks = [(0, 0, 0, BIOM_HEAD % (n_units, n_samples)), (2, 0, 0, BIOM_COLUMNS), (4, 0, 0, BIOM_DATA), (6, 0, 0, BIOM_END)]
    lines = lines.unionByName(spark.createDataFrame(marks, "part int, i long, j long, value string"))
    lines.orderBy("part", "i", "j").select("value").write.text(path)


def numbered_lines(spark: SparkSession, path: str, each_file: bool = False) -> DataFrame:
    """(file, line, value): lines numbered from 0 over all files in order of their names, or within ``each_file``.

    Spark splits plain files; the lines of each split are counted first, so that every split knows its first line's number.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    over = Window.partitionBy("file").orderBy("block") if each_file else Window.orderBy("file", "block")  # a row for each split
    splits = splits.withColumn("off", F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    return lines.join(splits, ["file", "block"]).select("file", (F.col("off") + F.col("id") - F.col("first")).alias("line"), "value")


def read_biom(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Counts (tu_id, sample_id, n) and metadata (tu_id, metadata as JSON) of what ``write_biom`` has written, by lines."""
    lines = numbered_lines(spark, path)
    places = {r["value"]: r["line"] for r in lines.where(F.col("value").isin(BIOM_COLUMNS, BIOM_DATA, BIOM_END)).collect()}
    between = lambda a, b: lines.where((F.col("line") > a) & (F.col("line") < b)).withColumn("value", F.regexp_replace("value", "^,", ""))
    columns, data = places[BIOM_COLUMNS], places[BIOM_DATA]
    units = between(0, columns).select((F.col("line") - 1).alias("_i"), F.get_json_object("value", "$.id").alias("tu_id"), F.get_json_object("value", "$.metadata").alias("metadata"))
    samples = between(columns, data).select((F.col("line") - columns - 1).alias("_j"), F.get_json_object("value", "$.id").alias("sample_id"))
    cell = F.from_json("value", "array<double>")
    cells = between(data, places[BIOM_END]).select(cell.alias("x")).select(F.col("x")[0].cast("long").alias("_i"), F.col("x")[1].cast("long").alias("_j"), F.col("x")[2].alias("n"))
    return cells.join(units, "_i").join(samples, "_j").select("tu_id", "sample_id", "n"), units.select("tu_id", "metadata")


def parse_hits(lines: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Hits and queries from lines (value, ord) of the commented hit format; queries without hits are in the second.

    The order of columns is the one given, else that of the ``# Fields:`` lines, else ``HIT_COLUMNS``; lines that say
    different orders are refused, since rows don't tell which one is theirs. Rows of fewer columns are left out.
    """
    if columns is None:
        said = [fields_of(r[0]) for r in lines.where(F.col("value").startswith("# Fields:")).select(F.regexp_replace("value", "\r$", "")).distinct().limit(2).collect()]
        if len(said) > 1:
            raise ValueError("hit lines of different columns; read the files one by one")
        columns = said[0] if said else HIT_COLUMNS
    queries = lines.where(F.col("value").startswith("# Query:")).select(parse_query_line(F.col("value")).alias("q"), F.col("ord").alias("q_ord")).select("q.*", "q_ord")
    cells = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("c"), F.col("ord").alias("hit_ord"))
    cells = cells.where(F.size("c") >= len(columns)).select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(columns)], "hit_ord")
    hits = cells.select(*[F.col(n).try_cast(HIT_TYPES[n]).alias(n) if n in HIT_TYPES else F.split(n, ";").alias(n) if n == "staxids" else F.col(n) for n in columns], "hit_ord")
    return hits, queries


def fields_of(line: str) -> list[str]:
    """Column names from a ``# Fields:`` line."""
    #: The long names of the fields.
    names = dict(zip(["query id", "subject id", "% identity", "alignment length", "mismatches", "evalue", "bit score", "subject tax ids", "subject title", "% query coverage per subject"], HIT_COLUMNS))
    return [names.get(x.strip(), x.strip()) for x in line.split(":", 1)[1].split(",")]


def read_hits(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    return parse_hits(spark.read.text(path).withColumn("ord", F.monotonically_increasing_id()), columns)


def read_taxonomy_xml(spark: SparkSession, path: str) -> DataFrame:
    """(taxid, parent, rank, name, aliases) of records with their lineage as ancestors."""
    entry = "struct<TaxId:string,ScientificName:string,Rank:string>"
    schema = f"TaxId string, ScientificName string, Rank string, ParentTaxId string, AkaTaxIds struct<TaxId:array<string>>, LineageEx struct<Taxon:array<{entry}>>"
    raw = spark.read.format("xml").option("rowTag", "Taxon").schema(schema).load(path)
    own = raw.select(F.col("TaxId").alias("taxid"), F.col("ParentTaxId").alias("parent"), F.col("Rank").alias("rank"), F.col("ScientificName").alias("name"), F.col("AkaTaxIds.TaxId").alias("aliases"), F.col("LineageEx.Taxon").alias("up"))
    chain = own.select(F.posexplode("up").alias("i", "t"), "up").select(F.col("t.TaxId").alias("taxid"), F.when(F.col("i") > 0, F.get("up", F.col("i") - 1)["TaxId"]).alias("parent"), F.col("t.Rank").alias("rank"), F.col("t.ScientificName").alias("name"), F.lit(None).cast("array<string>").alias("aliases"))
    return own.drop("up").unionByName(chain).groupBy("taxid").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("parent", "rank", "name", "aliases")])


def read_nodes(spark: SparkSession, nodes: str, names: str) -> DataFrame:
    """(taxid, parent, rank, name) from a taxonomy dump."""
    cut = lambda p: spark.read.text(p).select(F.split("value", r"\t\|\t?").alias("c"))
    n = cut(nodes).select(F.col("c")[0].alias("taxid"), F.col("c")[1].alias("parent"), F.col("c")[2].alias("rank"))
    return n.join(cut(names).where(F.col("c")[3] == "scientific name").select(F.col("c")[0].alias("taxid"), F.col("c")[1].alias("name")), "taxid", "left")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """(old, new) taxids."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(F.get(parts, F.lit(0)).alias("old"), F.get(parts, F.lit(2)).alias("new")).where("new is not null")


def new_taxids(cache: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ids that a lineage cache (taxid, lineage) lacks."""
    return wanted.select("taxid").distinct().join(cache, "taxid", "left_anti")


def through_cache(cache: DataFrame, wanted: DataFrame, resolve) -> tuple[DataFrame, DataFrame]:
    """The lineages (taxid, lineage) of the wanted ids, and the cache with those that it lacked.

    ``resolve`` gets a table of the missing ids (taxid) and gives their lineages; ids that it doesn't know stay unknown
    and are asked for again. What it gives is written down once, so that both results hold the same.
    """
    found = resolve(new_taxids(cache, wanted)).select("taxid", "lineage").dropDuplicates(["taxid"])
    both = materialize(cache.select("taxid", "lineage").unionByName(found), "taxonomy-cache")
    return both.join(wanted.select("taxid").distinct(), "taxid", "left_semi"), both


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Whole versions of a stored table, oldest first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(p.getName() for p in found if p.getName().startswith("v-") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def store_cache(cache: DataFrame, path: str, keep: int = 2) -> None:
    """Stores a taxonomy cache (taxid, lineage) as the next version in ``path``, beside its readers.

    A version counts once its writer has finished, so readers see the one before until then, and a writer that fails leaves
    nothing that is read. The ``keep`` newest versions stay, for readers that have begun with the one before. One writer at a time.
    """
    spark, known = cache.sparkSession, _versions(cache.sparkSession, path)
    cache.select("taxid", "lineage").write.mode("overwrite").parquet(f"{path}/v-{(int(known[-1][2:]) + 1 if known else 1):010}")
    for old in _versions(spark, path)[:-keep]:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def load_cache(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a stored cache; an empty one if there is none."""
    known = _versions(spark, path)
    return spark.read.parquet(f"{path}/{known[-1]}") if known else spark.createDataFrame([], "taxid string, lineage array<string>")


def read_list(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """The first tab-separated cell of each line that isn't blank."""
    return spark.read.text(path).select(F.trim(F.get(F.split("value", "\t"), F.lit(0))).alias(name)).where(F.col(name) != "")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) from two columns; a first row without a number is a header, rows without one are dropped."""
    cells = spark.read.text(path).select(F.split(F.regexp_replace("value", "\r$", ""), "[\t,]").alias("c"))
    return cells.select(F.trim(F.get("c", F.lit(0))).alias("name"), F.get("c", F.lit(1)).try_cast("double").alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Tax assignments (qseqid, taxonomy, bitscore, per_id, per_qcov) or a classifier's (id, taxon, confidence)."""
    df = spark.read.csv(path, sep="\t", header=True)
    if "Feature ID" in df.columns:
        return df.select(F.col("Feature ID").alias("id"), F.col("Taxon").alias("taxon"), F.col("Confidence").try_cast("double").alias("confidence"))
    return df.select(F.col("`#ID`").alias("qseqid"), "taxonomy", *[F.col(c).try_cast("double").alias(c) for c in ("bitscore", "per_id", "per_qcov")])


def first_hits(hits: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("qseqid").orderBy("hit_ord")
    return hits.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= n).drop("_i")
