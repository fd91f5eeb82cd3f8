from taxaflow.llm import quotes
from tests.llm.helpers import duck_rows, spark_rows

SCHEMA = "conv_id long, turn long, role string, text string"
TALK = [
    (1, 0, "user", "First question about trees.\nIt has two lines."),
    (1, 1, "assistant", "An answer here.\n\nAnd a second paragraph."),
    (1, 2, "user", "On Monday someone wrote:\n> First question about trees.\n> It has two lines.\n\nMore on that."),
    (1, 3, "user", "> An   ANSWER here.\n>\n>> first question about trees.\nReply."),
    (1, 4, "user", "> never said\nOdd."),
    (1, 5, "assistant", "No quotes > here, a > b."),
    (2, 0, "user", "> An answer here.\nother conversation"),
    (2, 7, "user", "gap"), (2, 7, "user", "> gap"), (2, 7, "user", "> gap"),
    (3, 1, "user", None), (3, 2, "user", ""), (None, 1, "user", "> x"), (4, None, "user", "> y\nz"), (4, 300, "user", "y"), (4, 900, None, "> y\n>> deep\n>>> deeper\n"),
]


def test_reply_order(spark, tmp_path):
    df = spark.createDataFrame(TALK, SCHEMA)
    got = quotes.reply_order(df)
    by = {(r.conv_id, r.turn): r for r in got.collect()}
    assert by[1, 2].reply_to == 0 and by[1, 2].linked and by[1, 2].text == "More on that." and by[1, 2].n_quoted == 2
    assert by[1, 3].reply_to == 1 and by[1, 3].quote_depth == 2 and by[1, 3].n_linked == 2 and by[1, 3].text == "Reply."
    assert by[1, 4].reply_to == 3 and not by[1, 4].linked and by[1, 5].reply_to == 4 and by[1, 5].text == TALK[5][3]
    assert by[2, 0].reply_to is None and not by[2, 0].linked and by[4, 900].reply_to == 300 and by[4, 900].quote_depth == 3
    assert by[None, 1].position is None and by[4, None].position is None and by[3, 1].text is None
    assert spark_rows(got) == duck_rows(quotes.sql(), tmp_path, conversations=df)


def test_long_conversations_are_numbered_in_buckets(spark):
    df = spark.createDataFrame([(1, i * 3, "user", f"t{i}" if i % 5 else f"> t{i - 1}\nx") for i in range(1000)], SCHEMA).repartition(9)
    got = {r.turn: r for r in quotes.reply_order(df, turns_per_bucket=64).collect()}
    assert all(got[i * 3].position == i and got[i * 3].reply_to == (i * 3 - 3 if i else None) for i in range(1000))
    assert sum(r.linked for r in got.values()) == 199


def test_nothing_and_clashing_names(spark):
    df = spark.createDataFrame(TALK[:2], SCHEMA)
    assert quotes.reply_order(df.where("false")).count() == 0
    assert quotes.reply_order(df.withColumnRenamed("role", "Position")).columns[:3] == ["conv_id", "turn", "text"]


def test_rows_without_place_meet_in_no_window_or_join(spark):
    df = spark.createDataFrame([(None, None, "user", "> x\ny")] * 500 + [(None, i, "user", None) for i in range(500)] + [(7, None, "user", f"> {i}") for i in range(500)] + TALK, SCHEMA)
    got = [r for r in quotes.reply_order(df).collect() if r.conv_id is None or r.turn is None]
    assert len(got) == 1502 and all(r.position is None and r.reply_to is None and not r.linked and r.n_quoted == r.n_linked == r.quote_depth == 0 for r in got)
    assert sum(r.text == "y" for r in got) == 500
