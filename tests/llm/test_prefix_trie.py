"""The prefix trie against plain dictionaries and SQL, over small and large blocks, and its edge cases."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from stationlake.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def nodes(df, *blocks):
    return sorted((tuple(r) for r in P.conversation_trie(df, *blocks).collect()), key=repr)


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.sql(P.oracle()).fetchall(), key=repr)


def odd_rows():
    rng = random.Random(3)
    rows = [(c, rng.choice([t, t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "yé", None, "", "z"]))
            for c in range(-12, 60) for t in range(rng.randint(0, 11))]
    rows += [(100, 0, "u", "hi")] * 3 + [(None, 0, "u", "x")]
    return rows + [(c, t, "u", "same") for c in range(200, 260) for t in range(4)]


@pytest.mark.parametrize("blocks", [(P.BLOCK, P.BLOCK_TURNS), (3, 1000), (2, 7), (1, 1)])
def test_against_dictionaries(spark, blocks):
    """Blocks of one or a few classes make almost every prefix cross an edge."""
    rows = odd_rows()
    assert nodes(spark.createDataFrame(rows, SCHEMA), *blocks) == P.brute_force(rows)


def test_sql_is_the_same():
    assert by_sql(odd_rows()) == P.brute_force(odd_rows())


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert nodes(df) == P.brute_force(rows) == by_sql(rows)


def test_empty_and_clashing_columns(spark):
    assert nodes(spark.createDataFrame([], SCHEMA)) == []
    rows = [(0, 0, "u", "a"), (1, 0, "u", "b"), (1, 1, "a", "x" * 100_000)]
    clash = spark.createDataFrame([(*r, 1, 2, 3, "k", "b") for r in rows], SCHEMA + ", seq int, names int, cls int, key string, block string")
    assert nodes(clash) == P.brute_force(rows)


def test_turnless_conversations_count_for_the_root(spark):
    """A conversation whose own turns all fall to an absent family head has none left."""
    from zlib import crc32

    c = next(c for c in range(1, 500) if c % 5 and crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "u", "only"), (c, 1, "a", "two")]
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == P.brute_force(rows)
    assert [(r[0], r[1], r[3], r[5]) for r in P.brute_force(rows)] == [(c, 0, 1, 1)]


def test_many_ids_at_one_node(spark):
    """More ids than one text holds, spread over ranges."""
    rows = [(c, 0, "u", "same") for c in range(0, 30_000, 5)]
    assert nodes(spark.createDataFrame(rows, SCHEMA).repartition(5)) == P.brute_force(rows)


def test_range_minima():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 64, 100):
        v = rng.integers(0, 6, n)
        table = P.RangeMinima(v)
        a, b = np.array([(i, j) for i in range(n) for j in range(i, n)]).T
        assert (table.least(a, b) == [v[i:j + 1].min() for i, j in zip(a, b, strict=True)]).all()
        for d in range(7):
            at = np.arange(n)
            right, left = table.reach(at, np.full(n, d), 1), table.reach(at, np.full(n, d), -1)
            for i in range(n):
                r = next((k for k in range(i, n - 1) if v[k + 1] < d), n - 1)
                le = next((k for k in range(i, 0, -1) if v[k] < d), 0)
                assert (left[i], right[i]) == (le, r)
