"""Operator 8: the SQL twin, exact totals of the splitting tree, agreement of plan and rows, edge cases."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from stationlake.llm import mixing

ROWS = ([(i, "w " * (1 + i % 7), f"src{i % 5}") for i in range(300)] + [(i, "a b c d", None) for i in range(300, 330)]
        + [(1000, None, "src0"), (1001, "", "src1"), (1002, " \n", None), (1003, "x " * 5000, "src3"),
           (5, "w " * 6, "src0"), (5, "w " * 6, "src0"), (None, "one two", "\U0001f600"), (None, None, "￿")])


def by_sql(rows, block_docs):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    return con.sql(mixing.oracle(block_docs))


@pytest.mark.parametrize("block_docs", [4, 512])
def test_taken_matches_sql(spark, make_docs, block_docs):
    got = mixing.taken(make_docs(ROWS, "size, target, taken, rank, n_blocks"), block_docs, shard_words=100)
    want = by_sql(ROWS, block_docs)
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_taken_is_near_the_target_and_bounded(spark, make_docs):
    docs = make_docs(ROWS)
    rows = mixing.taken(docs, 4, 100).collect()
    assert all(r.taken <= mixing.MAX_EPOCHS * r.size for r in rows)
    per: dict = {}
    for r in rows:  # the sources differ in size and target, which names them
        t = per.setdefault((r.source_size, r.target), [0, 0])
        t[0] += r.taken
        t[1] = max(t[1], r.size)
    for (_, target), (words, largest) in per.items():
        assert abs(words - target) <= largest / 2
    assert sum(t for _, t in per) == pytest.approx(sum(r.size for r in rows))


def test_each_source_is_near_its_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words, target = {}, {}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for r in mixing.taken(docs).collect():
        words[source[r.doc_id]] = words.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(words[s] / t - 1) < 0.005 for s, t in target.items())


def test_repeated_ids_are_drawn_one_by_one(spark, make_docs):
    """One id on 400 of a source's 500 rows: the target is met, each row by itself, and mix agrees."""
    rows = [(7, "w " * 10, "a")] * 400 + [(i, "w " * 2, "a") for i in range(100, 200)] + [(i, "w " * 9, "b") for i in range(1000, 1300)]
    docs = make_docs(rows).repartition(5)
    got = mixing.taken(docs, 16, 500).collect()
    for size in {r.source_size for r in got}:
        of = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in of) - of[0].target) <= 5
    assert len({r.taken for r in got if r.doc_id == 7}) == 2
    want = by_sql(rows, 16)
    assert sorted(tuple(r)[:5] for r in got) == sorted(want.fetchall())
    out = mixing.mix(docs, 16, 500).collect()
    assert Counter((r.doc_id, r["__shard"]) for r in out) == Counter((r.doc_id, s) for r in got for s in r.shards)


def test_targets_by_hand(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1)], "source string, __size long")
    t = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    # shares 1:2:3 of 1011; c stops at 3, then a at 30, the rest goes to b
    assert t == {"a": 30.0, "b": 978.0, "c": 3.0}


def test_tree_totals_are_exact(spark):
    draws = spark.createDataFrame([(r, i) for r, n in ((0, 100), (1, 7), (2, 33)) for i in range(n)], "rank long, seq int")
    for shards in (1, 2, 5, 8):
        q = mixing.split_quotas(draws, shards).collect()
        assert {r: sum(x.n for x in q if x["rank"] == r) for r in range(3)} == {0: 100, 1: 7, 2: 33}
        totals = Counter()
        for x in q:
            totals[x.shard] += x.n
        assert len(totals) == shards and max(totals.values()) - min(totals.values()) <= 2
        for r in range(3):  # a source's sequence is covered without gap or overlap
            spans = sorted((x["first"], x["first"] + x.n) for x in q if x["rank"] == r)
            assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_tree_is_a_fair_draw(spark):
    """Over many seeds, the left half of 20 + 20 blocks holds 10 of the first source on average, with the
    variance of the hypergeometric law (2.56)."""
    draws = spark.createDataFrame([(r, i) for r in range(2) for i in range(20)], "rank long, seq int").cache()
    left = []
    for seed in range(25):
        q = mixing.split_quotas(draws, 2, seed).collect()
        left.append(sum(x.n for x in q if x["rank"] == 0 and x.shard == 0))
    mean = sum(left) / len(left)
    assert abs(mean - 10) < 1.3
    assert 0.8 < sum((x - mean) ** 2 for x in left) / len(left) < 7


def test_mix_draws_what_taken_says(spark, make_docs):
    docs = make_docs(ROWS, "rank, block")
    out = mixing.mix(docs, 4, 100)
    again = mixing.mix(docs, 4, 100)
    key = lambda r: tuple(repr(x) for x in r)
    rows = out.collect()
    assert out.columns == [*docs.columns, "__shard"]
    assert sorted(rows, key=key) == sorted(again.collect(), key=key)
    got = Counter((r.doc_id, len((r.text or "").split())) for r in rows)
    size = Counter((r.doc_id, r.size) for r in mixing.taken(docs, 4, 100).collect())
    want = Counter()
    for r in mixing.taken(docs, 4, 100).collect():
        want[(r.doc_id, r.size)] += r.taken
    for k in size:
        assert got[k] * k[1] == want[k]


def test_any_column_name_may_be_the_callers(spark, make_docs):
    names = "__key, __rank, __block, __n, __keys, __epoch, __local, __source, __size, __shard, own_0, a.b"
    docs = make_docs(ROWS, names.replace("a.b", "`a.b`"))
    out = mixing.mix(docs, 4, 100, shard=None)
    assert out.columns == docs.columns
    plain = mixing.mix(make_docs(ROWS), 4, 100).drop("__shard")
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted((tuple(r)[:5] for r in out.collect()), key=key) == sorted((tuple(r) for r in plain.collect()), key=key)
    assert all(tuple(r)[5:] == ("x",) * 12 for r in out.collect())
    with pytest.raises(ValueError):
        mixing.mix(docs, 4, 100)


def test_empty_and_wordless(spark, make_docs):
    assert mixing.taken(make_docs([]), 4, 100).count() == 0
    assert mixing.mix(make_docs([]), 4, 100).count() == 0
    none = mixing.taken(make_docs([None, "", " "]), 4, 100).collect()
    assert len(none) == 3 and all(r.taken == 0 and r.target == 0 for r in none)
