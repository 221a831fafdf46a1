from __future__ import annotations

import pytest

from filingframe.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, line string, h string"


@pytest.fixture
def make(spark):
    def build(rows):
        return spark.createDataFrame([(c, t, "user", x, "l", "h") for c, t, x in rows], SCHEMA)

    return build


def ordered(df):
    return [tuple(r) for r in df.orderBy("conv_id", "thread", "turn").select("conv_id", "thread", "depth", "turn", "reply_to", "text").collect()]


def test_nested_quotes_link_to_their_originals(make):
    rows = [
        (1, 0, "How do I sort\nrows quickly?"),
        (1, 1, "Another matter."),
        (1, 2, "> How do  I SORT\n> rows quickly?\n\nUse an index."),
        (1, 3, "> > How do I sort\n> > rows quickly?\n> Use an index.\nWhich one?"),
        (1, 4, "> Another matter.\nYes?"),
        (2, 0, "> Use an index.\nNot said here."),
    ]
    assert ordered(quotes.reply_ordered(make(rows))) == [
        (1, 0, 0, 0, None, "How do I sort\nrows quickly?"),
        (1, 0, 1, 2, 0, "Use an index."),
        (1, 0, 2, 3, 2, "Which one?"),
        (1, 1, 0, 1, None, "Another matter."),
        (1, 1, 1, 4, 1, "Yes?"),
        (2, 0, 0, 0, None, "Not said here."),
    ]
    levels = {(r.turn, r.level): r.reply_to for r in quotes.links(make(rows)).filter("conv_id = 1").collect()}
    assert levels == {(2, 1): 0, (3, 1): 2, (3, 2): 0, (4, 1): 1}


def test_ties_and_repeats(make):
    rows = [(1, 0, "same"), (1, 1, "same"), (1, 2, "> same\nlatest"), (1, 2, "> same\nlatest"), (1, 3, "same\n> later than this")]
    out = quotes.reply_ordered(make(rows)).orderBy("turn").collect()
    assert [(r.turn, r.reply_to) for r in out] == [(0, None), (1, None), (2, 1), (2, 1), (3, None)]


@pytest.mark.parametrize("block", [1, 3, 256])
def test_long_chain_and_far_originals(make, monkeypatch, block):
    monkeypatch.setattr(quotes, "BLOCK", block)
    rows = [(1, 0, "line 0")] + [(1, t, f"> line {t - 1}\nline {t}") for t in range(1, 40)] + [(1, 50, "> line 0\nend")]
    out = {r.turn: r for r in quotes.reply_ordered(make(rows)).collect()}
    assert all(out[t].reply_to == t - 1 and out[t].thread == 0 and out[t].depth == t for t in range(1, 40))
    assert (out[50].reply_to, out[50].depth) == (0, 1)


def test_awkward_rows(make):
    rows = [(None, 0, "x"), (1, None, "> x"), (1, 0, None), (1, 1, ""), (1, 2, ">"), (1, 3, "> \n>> "), (1, 4, "y " * 100_000)]
    table = make(rows)
    out = quotes.reply_ordered(table)
    assert out.columns == ["conv_id", "thread", "depth", "turn", "reply_to", "role", "text"]
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert len(got) == 7 and all(r.reply_to is None for r in got.values())
    assert got[1, 0].text is None and got[1, 1].text == "" and got[1, 2].text == "" and len(got[1, 4].text) > 100_000
    assert quotes.reply_ordered(table.filter("false")).count() == 0


def test_sql_twin(spark, make, tmp_path):
    import duckdb

    rows = [
        (1, 0, "a b\nc d e"), (1, 1, "> a b\nf"), (1, 2, "> c d e\n> a b\n\n> > zz\ng"), (1, 3, "> f\n>> a b\nh"),
        (1, 4, "> h\n> g\nx"), (2, 0, "q"), (2, 1, "> q\n> a b\n r "), (2, 2, None),
    ]
    table = make(rows).select("conv_id", "turn", "role", "text")
    con = duckdb.connect()
    con.register("conversations", table.toArrow())
    want = con.execute(quotes.SQL).fetchall()
    got = [tuple(r) for r in quotes.reply_ordered(table).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_messages_of_one_turn_are_read_apart(make):
    rows = [(1, 0, "first"), (1, 1, "second"), (1, 2, "> first\nan answer"), (1, 2, "own words\n> second"), (1, 3, "> own words\nend")]
    found = [sorted(map(str, quotes.links(make(order)).collect())) for order in (rows, rows[::-1], rows[2:] + rows[:2])]
    assert found[0] == found[1] == found[2] and len(found[0]) == 3
    whole = [sorted(map(str, quotes.reply_ordered(make(order)).collect())) for order in (rows, rows[::-1])]
    assert whole[0] == whole[1]
