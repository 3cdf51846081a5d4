"""Quotation linking against a plain walk over all messages."""

import re

import pytest

from driftgate.llm.quote_linking import link_quotes, parse

SCHEMA = "conv_id long, turn long, role string, text string, thread_conv string"


def test_parse_levels_and_intro():
    own, quoted, _ = parse("Hi.\nOn Monday A wrote:\n> first line\n> second line\n>> older words here\nMy answer.")
    assert own == "Hi.\nMy answer."
    assert (1, "first line\nsecond line") in quoted and (2, "older words here") in quoted
    assert parse("")[0] == "" and parse("")[1] == []


@pytest.fixture(scope="module")
def messages(spark):
    rows = [
        (1, 0, "user", "alpha beta gamma delta epsilon zeta", "x"),
        (1, 1, "assistant", "one two three four five six seven", "x"),
        (1, 2, "user", "> Alpha  beta gamma\tdelta epsilon ZETA\nanswer to the first", "x"),
        (1, 3, "assistant", "no quote", "x"),
        (2, 1, "user", "> one two three four five six seven\nfrom elsewhere", "x"),  # first written at turn 1: not earlier
        (2, 4, "user", ">> alpha beta gamma delta epsilon zeta\n> one two three four five six seven\ndeep", "x"),
        (3, 0, "user", None, "x"),
        (3, 1, "user", "> never written by anyone else\nsure", "x"),
        (None, 1, "user", "lost", "x"),
        (4, None, "user", "lost too", "x"),
        (1, 3, "assistant", "no quote", "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_links_and_threads(messages):
    out = link_quotes(messages).collect()
    assert len(out) == 11
    got = {(r.conv_id, r.turn): r for r in out}
    assert (got[1, 2].parent_conv, got[1, 2].parent_turn, got[1, 2].linked) == (1, 0, True)
    assert got[1, 2].text == "answer to the first"
    assert (got[1, 3].parent_turn, got[1, 3].linked, got[1, 3].depth) == (2, False, 2)
    assert (got[2, 1].parent_conv, got[2, 1].linked) == (None, False)
    assert (got[2, 4].parent_conv, got[2, 4].parent_turn) == (1, 1)
    assert (got[2, 4].thread_conv, got[2, 4].thread_turn, got[2, 4].depth) == (1, 0, 2)
    assert (got[3, 1].parent_turn, got[3, 1].linked, got[3, 1].n_quotes) == (0, False, 1)
    assert got[3, 0].text == "" and got[None, 1].depth == 0
    # every reply comes after its parent
    place = {(r.conv_id, r.turn): i for i, r in enumerate(out)}
    for r in out:
        if r.parent_conv is not None:
            assert place[r.parent_conv, r.parent_turn] < place[r.conv_id, r.turn]


def test_deeper_passages_link_where_shallower_ones_have_no_original(spark):
    alpha, agree = "alpha beta gamma delta epsilon zeta", "I agree with all of that"
    rows = [
        (1, 0, "user", alpha, ""),
        (1, 1, "assistant", f"> {alpha}\n{agree}", ""),
        (1, 2, "user", f"> I agree, edited\n>> {alpha}\nmore", ""),  # the shallow passage was never written so
        (1, 3, "assistant", f"> {agree}\n>> {alpha}\nthe shallow one counts", ""),
        (1, 4, "user", f"> trimmed\n>> cut off\n>>> {agree}\n>>>> {alpha}\nthird level", ""),
        (5, 3, "user", f"> not found\n>> {alpha}\nfrom elsewhere", ""),
        (5, 4, "user", "> not found\n>> nor this\nnothing", ""),
    ]
    got = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn, r.linked) for r in link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {
        (1, 0): (None, None, False),
        (1, 1): (1, 0, True),
        (1, 2): (1, 0, True),
        (1, 3): (1, 1, True),
        (1, 4): (1, 1, True),
        (5, 3): (1, 0, True),
        (5, 4): (5, 3, False),
    }


def test_long_chain_and_table(spark):
    rows = [(7, t, "user", f"message number {t} has its own words" + (f"\n> message number {t - 1} has its own words" if t else ""), "") for t in range(50)]
    got = {r.turn: r for r in link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[t].depth == t and got[t].thread_turn == 0 and got[t].linked == (t > 0) for t in got)
    assert link_quotes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_walk(spark):
    from driftgate.llm.queries import op9_quote_linking

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    turns: dict[int, list[int]] = {}
    for r in rows:
        turns.setdefault(r.conv_id, []).append(r.turn)
    quoting = [r for r in rows if re.search(r"^\s*>", r.text or "", re.M)]
    assert not quoting  # then every message answers the turn before it
    for r in op9_quote_linking(spark, sf).collect():
        before = sorted(t for t in turns[r.conv_id] if t < r.turn)
        assert (r.parent_turn, r.depth, r.thread_turn) == (before[-1] if before else None, len(before), min(turns[r.conv_id]))
