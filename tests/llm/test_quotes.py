"""Quotation links on threads whose structure is known."""

from retail_layers.llm import queries, quotes

MAIL = [
    (1, 0, "ann", "Shall we meet on Monday?\n\nI am free all day.\nBring the plans."),
    (1, 1, "bob", "On Mon, Ann wrote:\n> Shall we meet on Monday?\n>\n> I am free all day.\n> Bring the plans.\n\nYes, at ten."),
    (1, 2, "cyn", "> I am FREE  all day.\nLucky you."),
    (1, 3, "ann", "Bob wrote:\n>> Shall we meet on Monday?\n> Yes, at ten.\nFine."),
    (1, 4, "dan", "> nobody said this\nHm."),
    (1, 5, "eve", "A new matter."),
    (1, 6, "bob", ">A new matter.\r\n> > something lost\rGo on."),
    (1, 7, "ann", "> Go on.\nNo."),
    (2, 0, "x", "Yes, at ten."),
    (2, 1, "y", "> A new matter.\nother conversation"),
    (3, 0, "x", None), (3, 1, "x", ""), (3, 2, "x", "> "), (None, 0, "x", "> A new matter."), (3, None, "x", "> A new matter."),
    (4, 5, "x", "> later\n"), (4, 6, "y", "later"), (4, 6, "y", "later"),
]
WANT = {  # quotes, deepest, linked, answers, thread, depth, text
    (1, 0): (0, 0, 0, None, 0, 0, "Shall we meet on Monday?\n\nI am free all day.\nBring the plans."),
    (1, 1): (1, 1, 1, 0, 0, 1, "Yes, at ten."),
    (1, 2): (1, 1, 1, 0, 0, 1, "Lucky you."),
    (1, 3): (2, 2, 2, 1, 0, 2, "Fine."),
    (1, 4): (1, 1, 0, None, 4, 0, "Hm."),
    (1, 5): (0, 0, 0, None, 5, 0, "A new matter."),
    (1, 6): (2, 2, 1, 5, 5, 1, "Go on."),
    (1, 7): (1, 1, 1, 6, 5, 2, "No."),
    (2, 0): (0, 0, 0, None, 0, 0, "Yes, at ten."),
    (2, 1): (1, 1, 0, None, 1, 0, "other conversation"),
    (3, 0): (0, 0, 0, None, 0, 0, ""), (3, 1): (0, 0, 0, None, 1, 0, ""), (3, 2): (0, 0, 0, None, 2, 0, ""),
    (None, 0): (0, 0, 0, None, 0, 0, ""), (3, None): (0, 0, 0, None, None, 0, ""),
    (4, 5): (1, 1, 0, None, 5, 0, ""), (4, 6): (0, 0, 0, None, 6, 0, "later"),
}


def test_known_threads(spark):
    df = spark.createDataFrame(MAIL, "conv_id bigint, turn bigint, role string, text string")
    df = df.selectExpr("*", "1 as own", "2 as hash", "3 as thread", "4 as _row", "5 as depth", "6 as conv")
    got = quotes.link_quotes(df).collect()
    assert len(got) == len(MAIL)
    for r in got:
        assert (r["quotes"], r["deepest"], r["linked"], r["answers"], r["thread"], r["depth"], r["text"]) == WANT[r["conv"], r["turn"]]


def test_lines_that_announce_nothing_stay(spark):
    texts = ["Here is the query I wrote:\n\nselect 1", "As Darwin wrote:", "He wrote:\nno quote\n> a quote",
             "Ann wrote:\n \n\n > a quote\nYes.", "On Monday I wrote:\r\nnothing"]
    df = spark.createDataFrame([(i, 0, "x", t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv"]: r["text"] for r in quotes.link_quotes(df).collect()}
    assert got == {0: texts[0], 1: texts[1], 2: "He wrote:\nno quote", 3: "Yes.", 4: "On Monday I wrote:\nnothing"}


def test_trimmed_quotes_are_linked(spark):
    rows = [
        (1, 0, "l1\nl2\nl3"), (1, 1, "> l1\n> l2\nanswer"), (1, 2, "> l1\n> l3\nnot in a row"),
        (2, 0, "One here. Two there! Three.\n\nSecond part.\n\nThird part."), (2, 1, "> Two there!\nyes"),
        (2, 2, "> Three.\n>\n> Second part.\nno"), (2, 3, "> Second part.\n>\n> Third part.\nwell"), (2, 4, "> One\nhalf a sentence"),
    ]
    df = spark.createDataFrame([(c, t, "x", m) for c, t, m in rows], "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv"], r["turn"]): (r["linked"], r["answers"]) for r in quotes.link_quotes(df).collect()}
    linked = {(1, 1), (2, 1), (2, 2), (2, 3)}
    assert got == {(c, t): (1, 0) if (c, t) in linked else (0, None) for c, t, _ in rows}


def test_long_chains_and_empty_tables(spark):
    chain = [(9, i, "x", (f"> say {i - 1}\n" if i else "") + f"say {i}") for i in range(70)]
    df = spark.createDataFrame(chain, "conv_id bigint, turn bigint, role string, text string")
    got = quotes.link_quotes(df).collect()
    assert all((r["thread"], r["depth"], r["text"]) == (0, r["turn"], f"say {r['turn']}") for r in got)
    assert quotes.link_quotes(df.limit(0)).count() == 0
    many = spark.createDataFrame([(1, 0, "x", "> deep\n" * 20_000 + "word " * 50_000)], df.schema)
    row = quotes.link_quotes(many).first()
    assert row["quotes"] == 1 and row["text"] == ("word " * 50_000).strip()


def test_given_conversations_in_a_native_plan(spark, given):
    df = queries.op2_quotes(spark, "/root/testdata/sf0.01")
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    want = sorted((r["conv_id"], r["turn"], r["text"].strip()) for r in given("conversations", "/root/testdata/sf0.01").collect())
    assert sorted((r["conv"], r["turn"], r["text"]) for r in df.collect()) == want
