"""Collocations against plain counting and SQL, over small and large chunks, and their edge cases."""

from __future__ import annotations

import random

import duckdb
import pytest

from stationlake.llm import setm as S

SCHEMA = "doc_id long, lang string, text string"


def found(df, **kw):
    return sorted(tuple(r) for r in S.collocations(df, **kw).collect())


def odd_rows():
    rng = random.Random(5)
    words = ["The", "of", "and", "a-b", "É", "x", "y", "new", "york", "city"]
    ends = ["", "", "", ",", ".", "\t", " ", "\n", "!?", "\v", " "]
    rows = [(rng.choice(["en", None, "und", "fr"]), " ".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 300))))
            for _ in range(120)]
    return rows + [("en", None), (None, ""), ("en", "new york city hall " * 400), ("de", "a " * 300), ("xx", "too few words")]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("sizes", [{}, {"chunk": 2000, "range_groups": 2000}])
def test_against_counting(spark, sizes):
    rows = odd_rows()
    want = S.brute_force(rows)
    assert found(frame(spark, rows), **sizes) == want and len(want) > 50


def test_sql_is_the_same(spark):
    con = duckdb.connect()
    con.register("documents", frame(spark, odd_rows()).toPandas())
    assert sorted(con.sql(S.oracle()).fetchall()) == S.brute_force(odd_rows())


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = S.brute_force([tuple(r) for r in docs.select("lang", "text").collect()])
    assert found(docs) == want and want


def test_ties_repeats_and_the_top(spark):
    """Equal scores and counts go by phrase; repeated rows count again; the top is per lang."""
    rows = [("en", "b a. a b. c d")] * 40 + [("de", "q r")] * 40
    got = found(frame(spark, rows), top=2)
    assert [(x[0], x[1], x[2], x[3]) for x in got] == [("de", 1, "q r", 40), ("en", 1, "c d", 40), ("en", 2, "a b", 40)]
    assert got == S.brute_force(rows, top=2)


def test_empty_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    rows = [("en", "p q")] * 30
    clash = spark.createDataFrame([(i, *r, 1, 2, "x") for i, r in enumerate(rows)], SCHEMA + ", chunk int, idx int, words string")
    assert found(clash) == S.brute_force(rows)


def test_scores_are_exact(spark):
    """Products past 64 bits divide without rounding."""
    a, cut = 9_000_000_000_000_000_001, 9_000_000_000_000_000_002
    df = spark.createDataFrame([(a, cut)], "a long, c long").selectExpr("a", "cast(c as decimal(20,0)) + cast(c as decimal(19,0)) as c")
    assert df.select(S._score(df.a, df.c)).first()[0] == S.SCALE * a // (2 * cut)


def test_long_pieces_and_cuts():
    text = (b"a b c\n" * 50 + b"d " * 500).translate(S.FOLD)
    parts = list(S._cut(text, 40))
    assert b"".join(parts) == text and all(len(p) <= 40 or b"\n" not in p for p in parts)
    words, pos, idx = S.occurrences(b"x y\n\nx  z")
    assert words == [b"x", b"y", b"z"] and idx.tolist() == [0, 1, 0, 2] and (pos[1:] == pos[:-1] + 1).tolist() == [True, False, True]
