import duckdb
from pyspark.sql import functions as F

from ratingloom.llm import quotations
from ratingloom.llm.oracle import ORACLES
from tools.check_oracles import compare

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_turn(df, conv=1):
    return {r.turn: r for r in df.collect() if r.conv_id == conv}


def test_nested_quotes_link_to_their_first_messages(spark):
    messages = spark.createDataFrame(
        [
            (1, 0, "user", "How do I sort?\nThanks!"),
            (1, 1, "assistant", "On Monday Ann wrote:\n> How do I sort?\nUse ORDER BY."),
            (1, 2, "user", "Bob wrote:\n> use  order by!\n>> How do I SORT?\nWorks."),
            (1, 3, "assistant", "> never said before\nWhat?"),
            (2, 0, "user", "> How do I sort?\nOther conversation"),
        ],
        SCHEMA,
    )
    found = by_turn(quotations.linked(messages))
    assert [found[t].text for t in range(4)] == ["How do I sort?\nThanks!", "Use ORDER BY.", "Works.", "What?"]
    assert [found[t].parent_turn for t in range(4)] == [None, 0, 1, None]
    assert [found[t].quoted_turns for t in range(4)] == [[], [0], [0, 1], []]
    assert [found[t].quote_levels for t in range(4)] == [0, 1, 2, 1]
    assert [(found[t].quoted_lines, found[t].linked_lines) for t in range(4)] == [(0, 0), (1, 1), (2, 2), (1, 0)]
    assert by_turn(quotations.linked(messages), 2)[0].parent_turn is None


def test_most_quoted_message_is_the_parent_and_later_wins_a_tie(spark):
    messages = spark.createDataFrame(
        [
            (1, 0, "a", "one\ntwo\nthree"),
            (1, 1, "b", "four\nfive"),
            (1, 2, "a", "> one\n> two\n> four\nso"),
            (1, 3, "b", "> one\n> four\nso"),
        ],
        SCHEMA,
    )
    found = by_turn(quotations.linked(messages))
    assert (found[2].parent_turn, found[3].parent_turn) == (0, 1)


def test_a_quote_wrapped_anew_is_linked(spark):
    messages = spark.createDataFrame(
        [
            (1, 0, "a", "I think that we\nshould sort. It is\nnot slow, is it?\n\nBye"),
            (1, 1, "b", "> I think that we should\n> sort. It is not\nYes.\n>> bye"),
            (1, 2, "a", "> It is not slow, is\n> it?\nNo. Why"),
        ],
        SCHEMA,
    )
    found = by_turn(quotations.linked(messages))
    assert [found[t].parent_turn for t in range(3)] == [None, 0, 0]
    assert [(found[t].linked_lines, found[t].linked_passages) for t in range(3)] == [(0, 0), (1, 2), (0, 1)]
    assert found[1].text == "Yes."


def test_threads_follow_replies(spark):
    # Two chains that alternate, the second of them deep, and a reply to an early message.
    data = [(1, t, "a", (f"> word {t - 2}.\n" if t > 1 else "") + f"word {t}.") for t in range(40)]
    data += [(1, 40, "b", "> word 1.\nlate"), (2, 5, "a", "word 0.")]
    result = quotations.linked(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r.turn, r.thread, r.depth) for r in result if r.conv_id == 1} == {
        *((t, t % 2, t // 2) for t in range(40)), (40, 1, 1),
    }
    order = [r.turn for r in result if r.conv_id == 1]
    assert order == [*range(0, 40, 2), *range(1, 40, 2), 40]
    assert [(r.thread, r.depth) for r in result if r.conv_id == 2] == [(5, 0)]


def test_reply_order_and_odd_rows(spark):
    messages = spark.createDataFrame(
        [
            (None, 1, "a", "> x"),
            (1, None, "a", "x"),
            (1, 2, None, None),
            (1, 0, "a", "x"),
            (1, 0, "a", "x"),
            (1, 1, "a", "> x\n" * 3000 + "end"),
            (1, 4, "a", "> > \n>"),
        ],
        SCHEMA,
    ).withColumn("lines", F.lit(1)).withColumn("level", F.lit("mine"))
    result = quotations.linked(messages)
    found = result.collect()
    assert len(found) == 7
    turns = [r.turn for r in found if r.conv_id == 1 and r.turn is not None]
    assert turns == sorted(turns)
    long = next(r for r in found if r.turn == 1 and r.conv_id == 1)
    assert (long.text, long.quoted_lines, long.linked_lines, long.parent_turn) == ("end", 3000, 3000, 0)
    assert quotations.linked(messages.limit(0)).count() == 0


def test_equals_its_sql_on_quoted_text(spark):
    said = ["Hello there", "How do I sort?", "Use ORDER BY.", "It works", "Why?", ""]
    data = []
    for conv in range(12):
        for turn in range(8):
            own = [said[(conv * turn + i) % 6] for i in range(1 + (conv + turn) % 3)]
            quoted = ["> " * (1 + (turn + i) % 2) + said[(conv + turn + i) % 6] for i in range(turn % 4)]
            head = ["Ann wrote:"] if quoted and conv % 2 else []
            data.append((conv, turn, "user", "\n".join(head + quoted + own)))
    data += [(99, 0, "user", "One two\nthree. Four!\n\nfive"), (99, 1, "user", "> One\n> two three.\n> Four\n>> five\nx\x01y\nz")]
    data += [(99, 2, "user", "> x y z\nok"), (None, 3, "user", "> five"), (99, None, "user", "> five")]
    messages = spark.createDataFrame(data, SCHEMA)
    base = duckdb.connect()
    base.register("conversations", messages.toArrow())
    verdict = compare(quotations.linked(messages).toArrow(), base.sql(ORACLES["op3_quotation_links"]).to_arrow_table())
    assert verdict == "equal, 101 rows"
    assert quotations.linked(messages).filter("parent_turn IS NOT NULL").count() > 20
