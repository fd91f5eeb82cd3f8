"""Queries over reads, barcodes, uniques and clusters, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaflow.functions.sequence import expected_errors
from taxaflow.operators import barcodes, classify, cluster, derep, mapping, reads, search, tree
from taxaflow.plans import adapters as A
from taxaflow.plans.adapters import sql

Q, O = {}, {}  # noqa: E741


def query(name: str, oracle: str | None = None):
    def keep(f):
        Q[name] = f
        if oracle:
            O[name] = oracle
        return f

    return keep


def ee(seq: str) -> str:
    return f"coalesce(list_sum([pow(10.0, -(ascii(c) - 33) / 10.0) FOR c IN string_split({seq}, '') IF c <> '']), 0)"


@query("expected_errors", sql(f"SELECT read_id, round({ee('seq')}, 4) AS ee FROM reads", "reads"))
def expected_errors_query(s, d):
    return A.reads(s, d).select("read_id", F.round(expected_errors(F.col("qual")), 4).alias("ee"))


@query("ee_filter", sql(f"SELECT read_id, round({ee('seq')}, 4) AS ee FROM reads WHERE {ee('seq')} <= 300.0", "reads"))
def ee_filter(s, d):
    return reads.filter_errors(A.reads(s, d), 300.0).select("read_id", F.round("ee", 4).alias("ee"))


@query("ee_discarded", sql(f"SELECT read_id FROM reads WHERE {ee('seq')} > 300.0", "reads"))
def ee_discarded(s, d):
    return reads.filter_errors(A.reads(s, d), 300.0, discarded=True).select("read_id")


LENGTHS = [50, 100, 200, 400]


@query("ee_statistics", sql(f"""
a AS (SELECT length, seq[1:length] AS q FROM reads, (SELECT unnest({LENGTHS}) AS length) WHERE length(seq) >= length),
b AS (SELECT length, {ee('q')} AS e FROM a)
SELECT length, count(*) AS n_reads, count(*) FILTER (e <= 20.0) AS ee_20_0, count(*) FILTER (e <= 40.0) AS ee_40_0, count(*) FILTER (e <= 80.0) AS ee_80_0 FROM b GROUP BY length""", "reads"))  # fmt: skip
def ee_statistics(s, d):
    return reads.error_statistics(A.reads(s, d), LENGTHS, (20.0, 40.0, 80.0))


@query("truncate_len", sql("SELECT read_id, seq[1:100] AS seq FROM reads WHERE length(seq) >= 100", "reads"))
def truncate_len(s, d):
    return reads.truncate(A.reads(s, d), 100).select("read_id", "seq")


@query("max_n", sql("SELECT read_id FROM reads WHERE length(seq) - length(replace(seq, 'N', '')) <= 2", "reads"))
def max_n(s, d):
    return reads.filter_unknown(A.reads(s, d), 2).select("read_id")


@query("homopolymer", sql("SELECT read_id FROM reads WHERE NOT regexp_matches(upper(seq), 'A{2}|C{2}|G{2}|T{2}')", "reads"))
def homopolymer(s, d):
    return reads.drop_runs(A.reads(s, d).withColumn("seq", F.upper("seq")), 2).select("read_id")


@query("ascii_scrub", sql("SELECT read_id, seq FROM reads", "reads"))
def ascii_scrub(s, d):
    return A.reads(s, d).select("read_id", "seq")


@query("base_frequencies", sql("b AS (SELECT unnest(string_split(seq, '')) AS base FROM reads) SELECT base, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM b WHERE base <> '' GROUP BY base", "reads"))
def base_frequencies(s, d):
    return reads.base_frequencies(A.reads(s, d).where("seq <> ''")).withColumn("share", F.round("share", 9))


@query("length_statistics", sql("SELECT count(*) AS n_reads, CAST(min(length(seq)) AS INT) AS min_len, round(avg(length(seq)), 6) AS avg_len, CAST(max(length(seq)) AS INT) AS max_len FROM reads", "reads"))
def length_statistics(s, d):
    return reads.length_statistics(A.reads(s, d)).withColumn("avg_len", F.round("avg_len", 6))


@query("longest_of_first", sql("SELECT CAST(max(length(seq)) AS INT) AS max_len, CAST(max(length(seq)) - 5 AS INT) AS last_len FROM (SELECT * FROM reads ORDER BY ord LIMIT 100)", "reads"))
def longest_of_first(s, d):
    return reads.longest_of_first(A.reads(s, d))


def spikes(s, d):
    """The benchmark's items as reference sequences to remove."""
    return A.read(s, d, "benchmark").select(F.regexp_replace("text", r"[^\x00-\x7F]", "?").alias("seq"))


#: Words of both strands of the references, and of reads; 4 different ones in common make a match.
SHARED_WORDS = """f AS (SELECT regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') AS seq FROM benchmark),
b AS (SELECT seq FROM f UNION ALL SELECT reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) FROM f),
rw AS (SELECT DISTINCT substr(seq, CAST(i AS BIGINT), 24) AS word FROM b, unnest(range(1, length(seq) - 22)) AS t(i)),
qw AS (SELECT DISTINCT read_id, substr(seq, CAST(i AS BIGINT), 24) AS word FROM reads, unnest(range(1, length(seq) - 22)) AS t(i)),
m AS (SELECT read_id FROM qw JOIN rw USING (word) GROUP BY read_id HAVING count(*) >= 4)"""


@query("reference_words_removed", sql(SHARED_WORDS + " SELECT read_id FROM reads WHERE read_id NOT IN (SELECT read_id FROM m)", "reads"))
def reference_words_removed(s, d):
    return reads.drop_matching(A.reads(s, d), spikes(s, d)).select("read_id")


@query("reference_reads_verified")
def reference_reads_verified(s, d):
    """Of the reads that share words with a reference, those that lie along it, wherever both are, with 97 % equal letters."""
    return reads.matching_reads(A.reads(s, d), spikes(s, d), identity=0.97)


@query("local_search")
def local_search(s, d):
    """Benchmark items among all documents, in the columns of hit files."""
    queries = A.read(s, d, "benchmark").select(F.col("item_id").cast("string").alias("qseqid"), F.col("text").alias("seq"))
    subjects = A.reads(s, d).select(F.col("read_id").alias("sseqid"), "seq", F.array("sample_id").alias("staxids"), F.col("grp").alias("stitle"))
    return search.local_search(queries, subjects, search.CLOSE, both_strands=False, evalue=0.001)


@query("demux_join", sql("SELECT read_id, barcode, sample_id FROM barcoded JOIN sample_map USING (barcode)", "barcoded", "sample_map"))
def demux_join(s, d):
    return reads.demultiplex(A.barcoded(s, d), A.sample_map(s, d)).select("read_id", "barcode", "sample_id")


@query("demux_unmatched", sql("SELECT read_id, barcode FROM barcoded WHERE barcode NOT IN (SELECT barcode FROM sample_map)", "barcoded", "sample_map"))
def demux_unmatched(s, d):
    return reads.unmatched(A.barcoded(s, d), A.sample_map(s, d))


def sparse_map(s, d):
    """Samples of which every other barcode never occurs."""
    m = A.sample_map(s, d)
    return m.withColumn("barcode", F.when(F.col("sample_id").cast("int") % 2 == 0, F.col("barcode")).otherwise(F.concat(F.lit("X"), "barcode")))


@query("barcode_counts_with_zero", sql("m AS (SELECT sample_id, CASE WHEN CAST(sample_id AS INT) % 2 = 0 THEN barcode ELSE 'X' || barcode END AS barcode FROM sample_map) SELECT sample_id, m.barcode, count(b.barcode) AS read_count FROM m LEFT JOIN barcoded b USING (barcode) GROUP BY 1, 2", "barcoded", "sample_map"))
def barcode_counts_with_zero(s, d):
    return reads.count_by_sample(A.barcoded(s, d), sparse_map(s, d))


@query("barcode_frequency", sql("SELECT barcode, count(*) AS n FROM barcoded GROUP BY barcode", "barcoded"))
def barcode_frequency(s, d):
    return reads.barcode_counts(A.barcoded(s, d))


NEAR = """c AS (SELECT barcode, count(*) AS n FROM barcoded GROUP BY barcode),
pr AS (SELECT c.barcode, n, sample_id, m.barcode AS bc, hamming(c.barcode, m.barcode) AS d FROM c, sample_map m WHERE hamming(c.barcode, m.barcode) <= 2),
nn AS (SELECT * FROM (SELECT *, min(d) OVER (PARTITION BY barcode) AS low FROM pr) WHERE d = low),
col AS (SELECT barcode, n, CAST(d AS INT) AS d, count(*) AS ties, min(sample_id) AS sample_id, min(bc) AS bc FROM nn GROUP BY 1, 2, 3)"""


def found(s, d):
    return barcodes.collisions(reads.barcode_counts(A.barcoded(s, d)), A.sample_map(s, d), 2)


@query("barcode_collisions", sql(NEAR + " SELECT barcode, n, d, ties, CASE WHEN d = 0 THEN 'bc' WHEN ties = 1 THEN 'm' || d ELSE '*' || d END AS kind FROM col", "barcoded", "sample_map"))
def barcode_collisions(s, d):
    return found(s, d).select("barcode", "n", "d", "ties", "kind")


@query("barcode_rescue_unique_nearest", sql(NEAR + " SELECT barcode, n, d, bc, sample_id FROM col WHERE ties = 1 AND d > 0", "barcoded", "sample_map"))
def barcode_rescue_unique_nearest(s, d):
    one = F.col("samples")[0]
    return found(s, d).where("ties = 1 and d > 0").select("barcode", "n", "d", one["bc"].alias("bc"), one["sample_id"].alias("sample_id"))


@query("barcode_gain", sql(NEAR + " SELECT CAST(sum(n) FILTER (d = 0) AS BIGINT) AS pm, CAST(coalesce(sum(n) FILTER (d > 0 AND ties = 1), 0) AS BIGINT) AS mm, round(coalesce(sum(n) FILTER (d > 0 AND ties = 1), 0) * 100 / sum(n) FILTER (d = 0), 6) AS percent FROM col", "barcoded", "sample_map"))
def barcode_gain(s, d):
    return barcodes.gain(found(s, d)).withColumn("percent", F.round("percent", 6))


@query("dereplicate", sql("SELECT md5(seq) AS digest, size, row_number() OVER (ORDER BY size DESC, seq) AS ord FROM (SELECT seq, count(*) AS size FROM reads GROUP BY seq)", "reads"))
def dereplicate(s, d):
    return derep.label(derep.uniques(A.reads(s, d))).select(F.md5("seq").alias("digest"), "size", "ord")


@query("merge_ids", sql("SELECT string_agg(read_id, ',' ORDER BY ord) AS id, min(ord) AS ord FROM reads GROUP BY upper(seq)", "reads"))
def merge_ids(s, d):
    return derep.merge_identical(A.reads(s, d).withColumn("id", F.col("read_id"))).select("id", "ord")


@query("per_group_uniques", sql("g AS (SELECT grp, seq, count(*) AS size FROM reads GROUP BY 1, 2) SELECT grp, md5(seq) AS digest, size, CAST(row_number() OVER (PARTITION BY grp ORDER BY size DESC, seq) AS INT) AS ord FROM g", "reads"))
def per_group_uniques(s, d):
    return derep.label_in_groups(derep.uniques(A.reads(s, d), 1, "grp"), "grp").select("grp", F.md5("seq").alias("digest"), "size", "ord")


#: Reads are cut to this length before they are dereplicated, and shorter ones dropped, as with a truncation length.
CUT, IDENTITY = 100, 0.97


def cut_reads(s, d):
    """Reads of the cut length; samples are sources of one language."""
    return reads.truncate(A.reads(s, d, CUT), CUT).withColumn("sample_id", F.concat_ws(".", "grp", "sample_id"))


def known_units(s, d):
    """The benchmark's items, cut like reads, as reference sequences; of equal ones the first."""
    seq = F.substring(F.regexp_replace("text", r"[^\x00-\x7F]", "?"), 1, CUT)
    items = A.read(s, d, "benchmark").select(F.concat(F.lit("K"), F.col("item_id").cast("string")).alias("id"), seq.alias("seq"), F.col("item_id").cast("bigint").alias("ord"))
    return items.where(F.length("seq") == CUT)


CUT_READS = f"r AS (SELECT read_id, concat_ws('.', grp, sample_id) AS sample_id, grp, seq[1:{CUT}] AS seq FROM reads WHERE length(seq) >= {CUT})"
KNOWN_UNITS = f"""kn AS (SELECT 'K' || item_id AS id, regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g')[1:{CUT}] AS seq, CAST(item_id AS BIGINT) AS ord FROM benchmark),
ku AS (SELECT * FROM kn WHERE length(seq) = {CUT})"""
NEAR_ENOUGH = f"levenshtein(a.seq, b.seq) <= {CUT - round(CUT * IDENTITY)}"


def greedy_sql(source: str, joins: str = NEAR_ENOUGH, prefix: str = "Otu", by: str = "1") -> str:
    """A serial pass as SQL: uniques u of the rows (seq, group) of ``source``, the earlier neighbours of each, and a recursion that looks at
    one unique of each group after the other; then the units ``cl`` (grp, seq, size, ord, centroid, centroid_ord, tu_id)."""
    return f"""u AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY size DESC, seq) AS ord FROM (SELECT {by} AS grp, seq, count(*) AS size FROM {source} GROUP BY 1, 2)),
nb AS MATERIALIZED (SELECT a.grp, a.ord, list(b.ord) FILTER (b.ord IS NOT NULL) AS near FROM u a LEFT JOIN u b ON a.grp = b.grp AND b.ord < a.ord AND {joins} GROUP BY a.grp, a.ord),
pass AS (
  SELECT grp, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS c FROM (SELECT DISTINCT grp FROM u)
  UNION ALL SELECT p.grp, i + 1, CASE WHEN list_has_any(c, coalesce(near, [])) THEN c ELSE list_append(c, nb.ord) END FROM pass p JOIN nb ON nb.grp = p.grp AND nb.ord = i + 1),
ce AS (SELECT grp, unnest(arg_max(c, i)) AS ord FROM pass GROUP BY grp),
un AS MATERIALIZED (SELECT grp, ord, seq, '{prefix}' || row_number() OVER (PARTITION BY grp ORDER BY ord) AS tu_id FROM ce JOIN u USING (grp, ord)),
own AS (SELECT grp, ord, coalesce(min(x) FILTER (x IN (SELECT c.ord FROM ce c WHERE c.grp = n.grp)), ord) AS centroid_ord FROM (SELECT grp, ord, unnest(list_append(coalesce(near, []), ord)) AS x FROM nb) n GROUP BY grp, ord),
cl AS (SELECT u.grp, u.seq, u.size, u.ord, un.seq AS centroid, centroid_ord, tu_id FROM own JOIN u USING (grp, ord) JOIN un ON un.grp = own.grp AND un.ord = own.centroid_ord)"""


def best_sql(seqs: str, units: str) -> str:
    """The nearest unit (seq, tu_id, identity) of each distinct sequence, ties to the earlier."""
    return f"SELECT a.seq, arg_min(b.id, (levenshtein(a.seq, b.seq), b.ord)) AS tu_id, 1 - min(levenshtein(a.seq, b.seq)) / {CUT}.0 AS identity FROM (SELECT DISTINCT seq FROM {seqs}) a JOIN {units} b ON {NEAR_ENOUGH} GROUP BY a.seq"


def recursive(body: str, *names: str) -> str:
    return sql(body, *names).replace("WITH ", "WITH RECURSIVE ", 1)


CLUSTERED = "SELECT seq, size, ord, centroid, centroid_ord, tu_id FROM cl"


@query("greedy_cluster", recursive(f"{CUT_READS},\n{greedy_sql('r')}\n{CLUSTERED}", "reads"))
def greedy_cluster(s, d):
    return cluster.cluster(derep.uniques(cut_reads(s, d)), IDENTITY)


BY_SKEW = "b.size >= 2 * a.size AND levenshtein(a.seq, b.seq) <= floor((log2(b.size / a.size) - 1) / 0.5 + 1e-9)"


@query("denoise", recursive(f"{CUT_READS},\n{greedy_sql('r', BY_SKEW, 'Asv')}\n{CLUSTERED}", "reads"))
def denoise(s, d):
    return cluster.denoise(derep.uniques(cut_reads(s, d)), alpha=0.5, least=1)


UNITS = "us AS (SELECT tu_id AS id, seq, ord FROM un)"


@query("map_reads_to_units", recursive(f"{CUT_READS},\n{greedy_sql('r')},\n{UNITS},\nbest AS ({best_sql('r', 'us')}) SELECT read_id, sample_id, tu_id, round(identity, 9) AS identity FROM r JOIN best USING (seq)", "reads"))
def map_reads_to_units(s, d):
    return mapping.map_to_own_units(cut_reads(s, d), IDENTITY).withColumn("identity", F.round("identity", 9))


@query("known_then_new_units", recursive(f"""{CUT_READS},\n{KNOWN_UNITS},\nb1 AS ({best_sql('r', 'ku')}),\nrest AS (SELECT * FROM r WHERE seq NOT IN (SELECT seq FROM b1)),
{greedy_sql('rest')},\nus AS (SELECT 'UB_' || tu_id AS id, seq, ord FROM un),\nb2 AS ({best_sql('rest', 'us')}),
m AS (SELECT tu_id, sample_id FROM r JOIN b1 USING (seq) UNION ALL SELECT tu_id, sample_id FROM rest JOIN b2 USING (seq))
SELECT tu_id, sample_id, count(*) AS n FROM m GROUP BY ALL""", "reads"))  # fmt: skip
def known_then_new_units(s, d):
    r = cut_reads(s, d)
    return mapping.known_then_new(r, r, known_units(s, d), lambda u: cluster.centroids(cluster.cluster(u, IDENTITY)), IDENTITY)[0]


@query("seeds_by_group", recursive(f"""{CUT_READS},\n{greedy_sql('r', by='grp')}
SELECT string_agg(tu_id || '_grp_' || grp, ',' ORDER BY grp, ord) AS id, upper(seq) AS seq FROM un GROUP BY upper(seq)""", "reads"))  # fmt: skip
def seeds_by_group(s, d):
    groups = cut_reads(s, d).select("sample_id", "grp").distinct()
    by = ["group"]
    return mapping.seeds_by_group(cut_reads(s, d), groups, "grp", lambda u: cluster.centroids(cluster.cluster(u, IDENTITY, by=by), by)).select("id", "seq")


KNOWN = "k AS (SELECT DISTINCT seq FROM reads WHERE ord % 2 = 0)"


@query("split_known_unbinned", sql(KNOWN + " SELECT read_id, seq IN (SELECT seq FROM k) AS known FROM reads", "reads"))
def split_known_unbinned(s, d):
    r = A.reads(s, d)
    known = r.where("ord % 2 = 0").groupBy("seq").agg(F.min("read_id").alias("id"), F.min("ord").alias("ord"))
    report = mapping.map_reads(r, known, 1.0)
    return report.select("read_id", F.lit(True).alias("known")).unionByName(mapping.unbinned(r, report).select("read_id", F.lit(False).alias("known")))


def labelled_texts(s, d):
    """Documents as reference sequences, their language and source as lineage."""
    return A.reads(s, d).select("seq", F.array(F.concat(F.lit("d__"), "grp"), F.concat(F.lit("p__"), "sample_id")).alias("lineage"))


def items(s, d):
    return A.read(s, d, "benchmark").select(F.col("item_id").cast("string").alias("qseqid"), F.regexp_replace("text", r"[^\x00-\x7F]", "?").alias("seq"))


def words_sql(table: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, substr(seq, CAST(i AS BIGINT), 8) AS word FROM {table}, unnest(range(1, length(seq) - 6)) AS t(i)"


@query("classify_words", sql(f"""
ref AS (SELECT ord AS id, seq, 'd__' || grp || ';p__' || sample_id AS taxon FROM reads WHERE length(seq) >= 8),
it AS (SELECT CAST(item_id AS VARCHAR) AS qseqid, regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') AS seq FROM benchmark),
rw AS ({words_sql('ref', 'id, taxon')}), qw AS ({words_sql('it', 'qseqid')}),
pr AS (SELECT word, (count(*) + 0.5) / ((SELECT count(*) FROM ref) + 1) AS p FROM rw GROUP BY word),
tw AS (SELECT taxon, word, ln((count(*) + any_value(p)) / any_value(p)) AS gain FROM rw JOIN pr USING (word) GROUP BY taxon, word),
tx AS (SELECT taxon, ln(count(*) + 1) AS cost FROM ref GROUP BY taxon), qn AS (SELECT qseqid, count(*) AS n FROM qw GROUP BY qseqid),
sc AS (SELECT qseqid, taxon, sum(gain) - any_value(n) * any_value(cost) AS score FROM qw JOIN tw USING (word) JOIN tx USING (taxon) JOIN qn USING (qseqid) GROUP BY qseqid, taxon)
SELECT qseqid, arg_max(taxon, (score, taxon)) AS taxonomy, round(max(score), 4) AS score FROM sc GROUP BY qseqid""", "reads"))  # fmt: skip
def classify_words(s, d):
    found = classify.classify(items(s, d), classify.train(labelled_texts(s, d), queries=items(s, d)), confidence=None)
    return found.select("qseqid", "taxonomy", F.round("score", 4).alias("score"))


@query("classify_confidence")
def classify_confidence(s, d):
    return classify.classify(items(s, d), classify.train(labelled_texts(s, d), queries=items(s, d)), confidence=0.7)


@query("nj_classify")
def nj_classify(s, d):
    seqs = A.read(s, d, "part").groupBy(F.col("p_name").alias("seq")).agg(F.min("p_partkey").alias("ord"))
    seqs = seqs.select(F.concat(F.lit("T"), "ord").alias("id"), "seq", "ord")
    targets = seqs.orderBy("ord").limit(3)
    first = targets.agg(F.min_by("id", "ord")).first()[0]
    return tree.classify(tree.chunk(seqs.join(targets.select("id"), "id", "left_anti")), targets.select("id", "seq"), first)
