"""Operator 5 against brute force: planted copies, hot groups over many blocks, random tries, edge cases."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import queries, trie_join
from stationlake.llm.graph import components

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\v\f\r"


def shingle_set(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    toks = [w for w in "".join(" " if c in SPACE else c for c in low).split(" ") if w]
    return {tuple(toks[i:i + 5]) for i in range(max(1, len(toks) - 4))} if toks else set()


def brute(rows):
    """doc_id, n_shingles, component_id of each row, sorted."""
    sets = [shingle_set(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j < i:
                    shared[j] += 1
        for j, k in shared.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def planted(seed, families=30, copies=12, length=(3, 60)):
    """Families of near copies, some at the edge of the threshold, with passages that many share."""
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(3000)
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rnd.randint(*length))] + (passage if rnd.random() < 0.4 else [])
        for _ in range(rnd.randint(1, copies)):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                t[rnd.randrange(len(t))] = word()
            rows.append((len(rows) * 7 % 1009, " ".join(t) if rnd.random() < 0.8 else "\n ".join(t).upper()))
    return rows


@pytest.mark.parametrize("block", [4, 1024])
def test_planted_families(spark, make_docs, block):
    rows = planted(block)
    assert result(trie_join.near_duplicates(make_docs(rows), block=block)) == brute(rows)


def test_one_hot_family_over_many_blocks(spark, make_docs):
    rows = planted(99, families=1, copies=1, length=(60, 61))
    base = rows[0][1].lower().split()
    rnd = random.Random(4)
    rows = []
    for i in range(160):  # one or two changed words: most pairs link, many do not
        t = list(base)
        for _ in range(rnd.choice([1, 1, 2, 3])):
            t[rnd.randrange(len(t))] = "x%d" % rnd.randrange(10 ** 6)
        rows.append((1000 - i, " ".join(t)))
    got = result(trie_join.near_duplicates(make_docs(rows), block=16))
    assert got == brute(rows)
    assert len({c for _, _, c in got}) > 1


def test_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op5_jaccard_join(spark, SF)
    assert result(got) == brute(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=10), min_size=1, max_size=14), st.integers(0, 3))
def test_trie_on_random_sets(sets, extra):
    """Sets over a small alphabet, ordered by number; some also have elements of their own."""
    sizes = [len(s) + (i * extra) % 3 for i, s in enumerate(sets)]
    arrays = [np.array(sorted(s), np.uint64) for s in sets]

    def joined(pairs):
        lab = list(range(len(sets)))
        for a, b in pairs:
            lab = [lab[b] if x == lab[a] else x for x in lab]
        return [[x == y for y in lab] for x in lab]

    true = [(i, j) for i in range(len(sets)) for j in range(i)
            if trie_join.links(len(sets[i] & sets[j]), sizes[i], sizes[j])]
    got = trie_join.trie_links(arrays, np.array(sizes), np.arange(len(sets)))
    assert {(max(p), min(p)) for p in got} <= set(true)
    assert joined(got) == joined(true)
    members = np.arange(0, len(sets), 2)
    some = trie_join.trie_links(arrays, np.array(sizes), np.arange(len(sets)), members)
    assert joined(some) == joined([p for p in true if p[0] % 2 == 0 or p[1] % 2 == 0])


@given(st.lists(st.integers(0, 2 ** 48 - 1), min_size=1, unique=True))
def test_packed_numbers(values):
    a = np.array(sorted(values), np.uint64)
    assert (trie_join.unpack(trie_join.pack(a)) == a).all()


ODD = [None, "", " \n", "one", "ONE", "one two three four", "one two three four five", "one  two\tthree four FIVE", "É é", "é É",
       "a b c d e f " * 3000, "a b c d e f " * 3001, "x " * 50, "x " * 60]


def test_edge_cases(spark, make_docs):
    rows = [*enumerate(ODD), (3, "one"), (3, "something else entirely here now"), (None, "one"), (None, "lonely words"), (None, None)]
    assert result(trie_join.near_duplicates(make_docs(rows, "cls, n, root, p"))) == brute(rows)
    assert trie_join.near_duplicates(make_docs([])).count() == 0
    assert trie_join.near_duplicates(make_docs([None, ""])).count() == 2


def test_keep_one(spark, make_docs):
    rows = [*enumerate(ODD), (3, "one"), (40, None)]
    docs = make_docs(rows, "cls, n, root, p, __cls, __id, __kept, own_1")
    kept = trie_join.keep_one(docs)
    assert kept.columns == docs.columns
    least = {(d, c) for d, n, c in brute(rows)}
    want = sorted([d for d, t in enumerate(ODD) if (d, d) in least or not shingle_set(t)] + [40])
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert trie_join.keep_one(make_docs([])).count() == 0


@pytest.mark.parametrize("part", [1 << 20, 150, 16])
def test_components_of_a_long_chain(spark, part):
    rnd = random.Random(2)
    ids = rnd.sample(range(10 ** 6), 300)
    edges = list(zip(ids[:200], ids[1:200])) + [(ids[200], x) for x in ids[201:]] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), part=part).collect()}
    assert got == {**dict.fromkeys(ids[:200], min(ids[:200])), **dict.fromkeys(ids[200:], min(ids[200:]))}


def test_components_without_edges(spark):
    none = spark.createDataFrame([(5, 5)], "a long, b long")
    assert components(none).count() == 0 and components(none.limit(0)).count() == 0
