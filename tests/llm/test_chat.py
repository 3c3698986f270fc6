import duckdb
from pyspark.sql import functions as F

from termloom.llm import chat

from .helpers import clash

ROWS = [
    (1, 0, "user", "Hello there, how does the engine work?\n\nSecond paragraph of the first mail."),
    (1, 1, "assistant", "> Hello there,  HOW does the engine work?\nIt works by magic and steam power."),
    (1, 2, "user", "Unrelated message with enough text."),
    (1, 3, "user", ">> Hello there, how does the engine work?\n> It works by magic and steam power.\n\nThat is a good reply to both."),
    (1, 4, "user", "> Second paragraph of the first mail.\nI answer the second paragraph."),
    (1, 4, "user", "> Second paragraph of the first mail.\nI answer the second paragraph."),
    (1, 5, None, None), (1, 6, "user", ""),
    (2, 5, "user", "> quote of nothing known here\nBody text"), (2, 7, "user", "x\n"),
    (1, 4000, "user", "> I answer the second paragraph.\n\nlate"),
    (1, 4001, "user", " > I answer the\n > second paragraph.\n\nlate wrapped"),
    (1, 4002, "user", "> Hello there, how does the engine work?\n> no match in this line at all\nboth"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def test_links_and_order(spark):
    got = {(r.conv_id, r.turn): r for r in chat.reply_order(clash(spark.createDataFrame(ROWS, SCHEMA))).collect()}
    parents = {k: (r.parent_turn, r.parent_kind) for k, r in got.items()}
    assert parents == {
        (1, 0): (None, "root"), (1, 1): (0, "quote"), (1, 2): (1, "previous"), (1, 3): (1, "quote"), (1, 4): (0, "quote"), (1, 5): (4, "previous"), (1, 6): (5, "previous"),
        (1, 4000): (4, "quote"), (1, 4001): (4, "quote"), (1, 4002): (0, "quote"), (2, 5): (None, "root"), (2, 7): (5, "previous"),
    }
    assert got[1, 3].body == "That is a good reply to both." and (got[1, 3].quoted_lines, got[1, 3].max_level) == (2, 2)
    assert all(got[1, t].position > got[1, r.parent_turn].position for (c, t), r in got.items() if c == 1 and r.parent_turn is not None)


def test_short_passages_and_paragraphs_link(spark):
    rows = [
        (1, 0, "user", "Sounds good."), (1, 1, "user", "Something else that was said."), (1, 2, "user", "> Sounds good.\nThen let us start."),
        (2, 0, "user", "\u660e\u5929\u89c1\u9762\u3002"), (2, 1, "user", "\u597d\u7684"), (2, 2, "user", "> \u660e\u5929\u89c1\u9762\u3002\n\u53ef\u4ee5"),
        (3, 0, "user", "The first paragraph is\nwrapped here.\n\nThe second one is long as\nwell.\n\nAnd a third one."), (3, 1, "user", "In between."),
        (3, 2, "user", "> The first paragraph\n> is wrapped here.\n>\n> The second one is\n> long as well.\nYes."),
        (4, 0, "user", "ok"), (4, 1, "user", "A long sentence that is quoted.\nmore"), (4, 2, "user", "no"), (4, 3, "user", "ok"), (4, 4, "user", "> A long sentence that is quoted.\n> ok\nThe longer counts."),
        (5, 0, "user", "!!!"), (5, 1, "user", "x"), (5, 2, "user", "> !!!\nNo letters, no link."),
    ]
    got = {(r.conv_id, r.turn): (r.parent_turn, r.parent_kind) for r in chat.reply_order(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k] for k in ((1, 2), (2, 2), (3, 2), (4, 4), (5, 2))] == [(0, "quote"), (0, "quote"), (0, "quote"), (1, "quote"), (1, "previous")]


def test_equals_sql(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    c = duckdb.connect()
    c.register("conversations", df.toPandas())
    want = sorted(map(str, c.execute(chat.ORACLE).fetchall()))
    assert sorted(map(str, [tuple(r) for r in chat.reply_order(df).collect()])) == want


def test_edges(spark):
    df = spark.createDataFrame([(None, 1, "user", "> a"), (1, None, "user", "b"), (None, None, None, None)], SCHEMA)
    got = chat.reply_order(df).collect()
    assert len(got) == 3 and all((r.parent_kind, r.depth, r.position) == ("root", 0, 1) for r in got)
    assert chat.reply_order(df.limit(0)).count() == 0


def test_long_chain_in_blocks(spark):
    df = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("message number "), "id").alias("text"))
    r = chat.reply_order(df).agg(F.max("depth"), F.max("position"), F.count_if(F.col("depth") == F.col("turn"))).first()
    assert tuple(r) == (2999, 3000, 3000)


def test_formatted(spark):
    parts = chat.formatted(chat.reply_order(spark.createDataFrame(ROWS, SCHEMA)), part=4).where("conv_id = 1").orderBy("part").collect()
    assert len(parts) == 3 and parts[0].text.startswith("<|user|>\nHello there") and "> " not in "".join(p.text for p in parts)


def test_main_path_is_native(spark):
    plan = chat.reply_order(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_second_query_quotes_earlier_turns(spark):
    from termloom.llm import queries as q

    kinds = {r.parent_kind: r["count"] for r in q.quoting_conversations(spark, "/root/testdata/sf0.001").groupBy("parent_kind").count().collect()}
    assert kinds["quote"] > 20


def test_places_in_long_and_wide_conversations(spark, monkeypatch):
    """Ranges of depths and blocks of turns of very few: a chain, and a star whose turns all quote the first."""
    monkeypatch.setattr(chat, "TURNS", 4)
    rows = [(1, i, "u", f"message {i}") for i in range(50)] + [(2, 0, "u", "the first message")] + [(2, i, "u", f"> the first message\nanswer {i}") for i in range(1, 40)]
    rows += [(2, 7, "a", "an other row of turn seven"), (2, 7, "a", "an other row of turn seven")]
    got = chat.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for conv in (1, 2):
        own = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, len(own) + 1))
        assert [(r.depth, r.turn, r.role, r.body) for r in own] == sorted((r.depth, r.turn, r.role, r.body) for r in own)
    assert max(r.depth for r in got if r.conv_id == 1) == 49 and max(r.depth for r in got if r.conv_id == 2) == 1
