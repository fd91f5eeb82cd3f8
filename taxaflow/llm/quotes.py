"""Chat formatting: quotations linked to the messages they quote, and conversations in reply order without quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import tidy

#: Quote marks at the start of a line, and the line that introduces a quote (in a few languages).
MARKS = r"^[ \t]*((?:>[ \t]*)+)"
QUOTED = r"(^|\n)[ \t]*>"
INTRO = r"(?m)^(?:On|Am|Le|El)[ \t][^\n]*(?:wrote|schrieb[^\n]*|a écrit|escribió)[ \t]*:[ \t]*\r?\n(?:[ \t]*\r?\n)?(?=[ \t]*>)"


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def normal(text: Column) -> Column:
    """A passage as it is compared: lower case, white space as single blanks, no quote marks at its start."""
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(text, MARKS, ""), r"[ \t\r\n]+", " ")))


def without_quotes(text: Column) -> Column:
    """The text without quoted lines and the lines that introduce them; untouched if it quotes nothing."""
    lines = F.split(F.regexp_replace(text, INTRO, ""), "\n")
    own = F.array_join(F.filter(lines, lambda x: quote_level(x) == 0), "\n")
    return F.when(text.rlike(QUOTED), F.regexp_replace(F.regexp_replace(own, r"\n(?:[ \t\r]*\n){2,}", "\n\n"), r"^[ \t\r\n]+|[ \t\r\n]+$", "")).otherwise(text)


def _lines(messages: DataFrame) -> DataFrame:
    """(conv, turn, rid, i, level, line): every line with a character besides marks and white space, and the blank ones as ''."""
    lines = messages.select("_conv", "_turn", "_rid", F.posexplode(F.split("_text", "\n")).alias("i", "line"))
    return lines.select("_conv", "_turn", "_rid", "i", quote_level(F.col("line")).alias("level"), normal(F.col("line")).alias("line"))


def _units(lines: DataFrame) -> DataFrame:
    """(conv, turn, rid, level, unit, size): passages (runs of lines of a level, cut at blank lines) and their lines."""
    w = Window.partitionBy("_rid").orderBy("i")
    cut = (F.col("line") == "") | (F.col("level") != F.lag("level").over(w)) | (F.lag("line").over(w) == "")
    runs = lines.withColumn("cut", F.coalesce(cut.cast("int"), F.lit(1))).withColumn("run", F.sum("cut").over(w)).where("line <> ''")
    whole = runs.groupBy("_conv", "_turn", "_rid", "level", "run").agg(F.sort_array(F.collect_list(F.struct("i", "line"))).alias("l"))
    whole = whole.select("_conv", "_turn", "_rid", "level", F.array_join(F.transform("l", lambda x: x.line), " ").alias("unit"))
    every = whole.unionByName(runs.select("_conv", "_turn", "_rid", "level", F.col("line").alias("unit"))).distinct()
    return every.withColumn("size", F.length("unit")).withColumn("unit", F.md5("unit"))


def reply_order(messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", text: str = "text", turns_per_bucket: int = 256) -> DataFrame:
    """Every message with its place in the conversation, the message it answers, and its text without quotes.

    Lines that start with ``>`` are quoted, as many levels deep as they have marks. Quoted passages and lines, and the
    messages' own ones, are normalised (case, white space, marks) and hashed; a quotation belongs to the last earlier
    message of its conversation with that passage as its own text. A message answers the one from which it quotes most
    at level 1 (ties: the later), else the message before it. In the result's order each answer follows what it answers.

    Replaces text and adds position (from 0), reply_to (turn, null for the first), linked (found by a quotation),
    quote_depth, n_quoted (quoted lines) and n_linked (quoted passages and lines that were found).

    Null texts quote nothing. Rows with null conversation or turn are kept, with null position and reply_to, and link to
    nothing. Rows that share a turn are ordered by text and are never each other's answer unless one quotes an earlier
    turn. Blank quoted lines don't count. An empty table gives an empty result; other columns pass through and ones
    named like added columns are replaced. Long conversations are numbered in buckets of turns, not in one task.
    """
    added = ["position", "reply_to", "linked", "quote_depth", "n_quoted", "n_linked"]
    messages = tidy(messages, [conv, turn, text], [*added, "_conv", "_turn", "_rid", "_text", "_bucket", "_n", "_off", "_last"])
    rows = messages.withColumn("_conv", F.col(conv)).withColumn("_turn", F.col(turn)).withColumn("_text", F.col(text))
    rows = rows.withColumn("_rid", F.md5(F.concat_ws("\0", F.md5(F.coalesce("_text", F.lit(""))), F.col("_conv").cast("string"), F.lit("|"), F.col("_turn").cast("string"))))

    quoting = rows.where(F.col("_text").rlike(QUOTED) & F.col("_conv").isNotNull() & F.col("_turn").isNotNull()).select("_conv", "_turn", "_rid", "_text").dropDuplicates(["_rid"])
    quoted = _lines(quoting).where("level > 0")
    depth = quoted.where("line <> ''").groupBy("_rid").agg(F.max("level").alias("quote_depth"), F.count(F.lit(1)).alias("n_quoted"))
    asked = _units(quoted)
    talks = quoting.select("_conv").distinct()
    told = rows.where(F.col("_turn").isNotNull()).join(talks, "_conv", "left_semi").select("_conv", "_turn", "_rid", "_text").dropDuplicates(["_rid"])
    told = _units(_lines(told).where("level = 0"))
    told = told.join(asked.select("_conv", "unit").distinct(), ["_conv", "unit"], "left_semi")
    both = asked.withColumn("from", F.lit(None).cast(rows.schema["_turn"].dataType)).unionByName(told.withColumn("from", F.col("_turn")))
    earlier = Window.partitionBy("_conv", "unit").orderBy("_turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("source", F.max("from").over(earlier)).where("level > 0 and source is not null")
    votes = found.groupBy("_rid", "source").agg(F.sum(F.when(F.col("level") == 1, F.col("size")).otherwise(0)).alias("votes"), F.count(F.lit(1)).alias("n"))
    links = votes.groupBy("_rid").agg(F.max(F.when(F.col("votes") > 0, F.struct("votes", "source"))).alias("top"), F.sum("n").alias("n_linked"))
    facts = depth.join(links, "_rid", "left").select("_rid", "quote_depth", "n_quoted", F.col("top.source").alias("_source"), "n_linked")

    whole = F.col("_conv").isNotNull() & F.col("_turn").isNotNull()
    placed = rows.where(whole).withColumn("_bucket", F.floor(F.col("_turn") / turns_per_bucket))
    inside = Window.partitionBy("_conv", "_bucket").orderBy("_turn", F.md5("_text"))
    sizes = placed.groupBy("_conv", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.max("_turn").alias("_last"))
    before = Window.partitionBy("_conv").orderBy("_bucket")
    sizes = sizes.select(
        "_conv", "_bucket", F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"), F.lag("_last").over(before).alias("_last"))
    previous = Window.partitionBy("_conv", "_bucket").orderBy("_turn").rangeBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_n", F.row_number().over(inside) - 1).withColumn("_before", F.max("_turn").over(previous))
    placed = placed.join(sizes, ["_conv", "_bucket"], "left").join(facts, "_rid", "left")
    loose = rows.where(~whole)  # these have no place, so that they needn't meet in a window or a join
    placed = placed.unionByName(loose, allowMissingColumns=True)
    out = (
        placed.withColumn("position", (F.col("_off") + F.col("_n")).cast("long"))
        .withColumn("linked", F.col("_source").isNotNull())
        .withColumn("reply_to", F.when(F.col("_off").isNotNull(), F.coalesce("_source", "_before", "_last")))
        .withColumn("quote_depth", F.coalesce("quote_depth", F.lit(0)).cast("int"))
        .withColumn("n_quoted", F.coalesce("n_quoted", F.lit(0)).cast("long"))
        .withColumn("n_linked", F.coalesce("n_linked", F.lit(0)).cast("long"))
        .withColumn(text, without_quotes(F.col(text)))
    )
    return out.select(*[F.col(f"`{c}`") for c in messages.columns], *added)


def sql(turns_per_bucket: int = 256) -> str:
    """DuckDB SQL for ``reply_order`` over table ``conversations`` (conv_id, turn, role, text)."""
    marks, intro = MARKS, INTRO.replace("'", "''")
    level = lambda x: f"length(regexp_replace(regexp_extract({x}, '{marks}', 1), '[^>]', '', 'g'))"
    normal_ = lambda x: f"trim(lower(regexp_replace(regexp_replace({x}, '{marks}', ''), '[ \\t\\r\\n]+', ' ', 'g')))"
    intro = intro.replace("(?=[ \\t]*>)", "([ \\t]*>)")
    return f"""
WITH m AS (SELECT *, row_number() OVER () AS rid, regexp_matches(text, '(^|\\n)[ \\t]*>') AS quotes FROM conversations),
l AS (SELECT conv_id, turn, rid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
      FROM m WHERE turn IS NOT NULL AND conv_id IN (SELECT conv_id FROM m WHERE quotes AND turn IS NOT NULL)),
n AS (SELECT conv_id, turn, rid, i, {level("line")} AS level, {normal_("line")} AS line FROM l),
c AS (SELECT *, CASE WHEN line = '' OR level <> lag(level) OVER w OR lag(line) OVER w = '' OR lag(level) OVER w IS NULL THEN 1 ELSE 0 END AS cut
      FROM n WINDOW w AS (PARTITION BY rid, level > 0 ORDER BY i)),
r AS (SELECT *, sum(cut) OVER (PARTITION BY rid, level > 0 ORDER BY i) AS run FROM c),
p AS (SELECT conv_id, turn, rid, level, string_agg(line, ' ' ORDER BY i) AS unit FROM r WHERE line <> '' GROUP BY conv_id, turn, rid, level, run),
u AS (SELECT * FROM p UNION SELECT conv_id, turn, rid, level, line FROM r WHERE line <> ''),
f AS (SELECT a.rid, a.level, a.unit, max(b.turn) AS source FROM u a JOIN u b ON a.conv_id = b.conv_id AND a.unit = b.unit AND b.level = 0 AND b.turn < a.turn
      WHERE a.level > 0 GROUP BY a.rid, a.level, a.unit),
v AS (SELECT rid, source, sum(CASE WHEN level = 1 THEN length(unit) ELSE 0 END) AS votes, count(*) AS n FROM f GROUP BY rid, source),
t AS (SELECT rid, max({{'votes': votes, 'source': source}}) FILTER (votes > 0) AS best, sum(n) AS n FROM v GROUP BY rid),
d AS (SELECT rid, max(level) AS quote_depth, count(*) AS n_quoted FROM n WHERE level > 0 AND line <> '' GROUP BY rid)
SELECT m.conv_id, m.turn, m.role,
  CASE WHEN quotes THEN regexp_replace(regexp_replace(array_to_string(list_filter(string_split(regexp_replace(m.text, '{intro}', '\\1', 'g'), chr(10)), lambda x: {level("x")} = 0), chr(10)),
    '\\n(?:[ \\t\\r]*\\n){{2,}}', chr(10) || chr(10), 'g'), '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g') ELSE m.text END AS text,
  CASE WHEN m.conv_id IS NOT NULL AND m.turn IS NOT NULL
       THEN row_number() OVER (PARTITION BY m.conv_id ORDER BY m.turn, md5(m.text)) - 1 END AS position,
  CASE WHEN m.conv_id IS NOT NULL AND m.turn IS NOT NULL THEN coalesce(t.best.source, max(m.turn) OVER (PARTITION BY m.conv_id ORDER BY m.turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) END AS reply_to,
  t.best.source IS NOT NULL AS linked, CAST(coalesce(d.quote_depth, 0) AS INT) AS quote_depth,
  CAST(coalesce(d.n_quoted, 0) AS BIGINT) AS n_quoted, CAST(coalesce(t.n, 0) AS BIGINT) AS n_linked
FROM m LEFT JOIN t USING (rid) LEFT JOIN d USING (rid)"""
