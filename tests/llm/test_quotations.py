"""Quotation linking against its SQL and by hand."""

import random

import duckdb
import pandas as pd

from registry_spark.llm.queries import ORACLES
from registry_spark.llm.quotations import quotation_links, reply_order

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string, words string"
COLUMNS = ["conv_id", "turn", "role", "text"]


def both(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)
    conversations = pd.DataFrame(rows, columns=COLUMNS).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("given", conversations)
    con.execute("CREATE TABLE conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role::VARCHAR AS role, text::VARCHAR AS text FROM given")
    got = reply_order(df)
    want = con.execute(ORACLES["op5_quotations"])
    order = [d[0] for d in want.description]
    key = lambda r: tuple(map(str, r))
    return sorted(map(tuple, got.select(*order).collect()), key=key), sorted(want.fetchall(), key=key), got


def test_nested_levels_and_order(spark):
    rows = [
        (1, 0, "user", "How do I sort\na list of words?"),
        (1, 1, "assistant", "Use the sorted function please.\n\nIt takes a key."),
        (1, 2, "user", "> how do I  sort a list\n> of words?\nAny other way than that one?"),
        (1, 3, "user", ">> How do I sort\n>> a list of words?\n> use the sorted function please.\nThanks."),
        (1, 4, "user", "> Thanks.\n> Never said by anyone at all\nWhat?"),
    ]
    got, want, df = both(spark, rows)
    assert got == want
    by_turn = {r["turn"]: r for r in df.collect()}
    assert [by_turn[t]["parent_turn"] for t in range(5)] == [None, None, 0, 1, None]
    assert by_turn[3]["max_depth"] == 2 and by_turn[3]["n_linked"] == 2 and by_turn[3]["text"] == "Thanks."
    assert by_turn[2]["thread_turn"] == 0 and by_turn[3]["thread_turn"] == 1


def test_long_chain(spark):
    rows = [(7, t, "user", (f"> message number {t - 1} of the chain\n" if t else "") + f"message number {t} of the chain") for t in range(20)]
    got, want, df = both(spark, rows)
    assert got == want
    last = df.filter("turn = 19").first()
    assert (last["thread_turn"], last["reply_depth"], last["parent_turn"]) == (0, 19, 18)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "> a b c d\nx"), (1, None, "user", "> a b c d\nx"), (1, 0, None, None), (1, 1, "user", ""),
        (1, 2, "user", ">" * 5000 + " a b c d"), (1, 3, "user", "a b c d"), (1, 4, "user", "> a b c d\n"), (1, 4, "user", "> a b c d\n"),
        (1, 5, "user", ">\n>\n> \nonly blank quotes"), (2, 0, "user", "> a b c d"), (1, 4, "other", "no quote"),
        (3, 0, "user", "word " * 50_000), (3, 1, "user", "> " + "word " * 50_000 + "\nwhole"), (3, 2, "user", "\n".join(["> q"] * 20_000)),
    ]
    got, want, _ = both(spark, rows)
    assert got == want and len(got) == len(rows)


def test_random_threads(spark):
    random.seed(3)
    phrases = [f"phrase {a} about topic {b}" for a in range(6) for b in range(4)]
    rows = []
    for conv in range(12):
        for turn in range(8):
            lines = [("> " * random.choice([0, 0, 1, 1, 2])) + random.choice(phrases) for _ in range(random.randint(0, 5))]
            rows.append((conv, turn, "user", "\n".join(lines)))
    got, want, _ = both(spark, rows)
    assert got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert reply_order(empty).collect() == [] and quotation_links(empty).collect() == []


def test_part_of_a_message_quoted(spark):
    rows = [
        (1, 0, "user", "a b c d e f g\nh i j k l m n\n\nanother paragraph stands here\nwith more words, lovely ones"),
        (1, 1, "user", "> a b c d e\n> f g h i j\n> k l m n\nre-wrapped paragraph"),
        (1, 2, "user", "> d e f g h\n> i j k l\n> m n and some words of nobody\npart of it, changed at the end"),
        (1, 3, "user", "> lovely ones\nshort and said once"),
        (1, 4, "user", "we say lovely ones again"),
        (1, 5, "user", "> lovely ones\nshort and said twice by now"),
        (1, 6, "user", "> nothing like this was said\n> k l z\nno origin"),
        (1, 7, "user", "> no such thing\n>\n> e f g h i\nsecond paragraph of the quotation"),
        (2, 0, "user", "> a b c d e\n> f g h i j\n> k l m n\nanother conversation"),
    ]
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)
    got = {(r["conv_id"], r["turn"]): r for r in reply_order(df).collect()}
    assert [got[1, t]["parent_turn"] for t in range(8)] == [None, 0, 0, 0, None, None, None, 0]
    assert [got[1, t]["n_linked"] for t in range(8)] == [0, 1, 1, 1, 0, 0, 0, 1]
    assert got[1, 2]["thread_turn"] == 0 and got[2, 0]["parent_turn"] is None
