"""Operators 4, 6 and 10: held-out accuracy, brute force, and the edge cases."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import quality_fm, quality_rules, queries, url_filter

SF = "/root/testdata/sf0.1"
ODD = [None, "", " \n\t ", "a", "a b c " * 40, "X" * 70000, "\u00e9\u2028 \x1c x\x85y", "#$ %& |<> a\na\n\na",
       "the same text", "the same text"]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def truth(labels):
    return {r.doc_id: r.quality for r in labels.collect()}


def test_fm_held_out_accuracy(spark, truth):
    rows = queries.op4_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    own = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    for label in (0, 1):
        hit = [p == y for p, y in own if y == label]
        assert np.mean(hit) > 0.9, (label, len(hit))


def test_fm_sum_of_squares_is_the_pairwise_sum():
    rng = np.random.default_rng(1)
    model = quality_fm.FactorisationMachine(rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, 3)))
    idx, val = quality_fm.vector("some words here, some more", 26)
    pairs = sum(model.v[idx[i]] @ model.v[idx[j]] * val[i] * val[j]
                for i in range(len(idx)) for j in range(i + 1, len(idx)))
    assert model.logits(idx, val, np.array([len(idx)]))[0] == pytest.approx(model.w[idx] @ val + pairs, rel=1e-4)


def test_fm_edge_cases(spark, make_docs, labels):
    docs = make_docs(ODD, "score, held_out, predicted, label")
    out = {r.doc_id: r for r in quality_fm.score_quality(docs, labels).collect()}
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out.values())
    assert out[8].score == out[9].score
    assert quality_fm.score_quality(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality_fm.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    one = spark.createDataFrame([(None, None, 0), (0, None, 1), (0, 1, 0), (0, 0, 1)], labels.schema)
    assert len(quality_fm.score_quality(docs.union(docs), one).collect()) == 2 * len(ODD)


def test_rules_held_out_accuracy(spark, truth):
    rows = [r for r in queries.op10_quality_rules(spark, SF).collect() if crc32(str(r.doc_id).encode()) % 3 == 1]
    own = [(r.kept, truth[r.doc_id]) for r in rows if r.doc_id in truth and not r.base_failed]
    for label in (0, 1):
        assert np.mean([k == bool(y) for k, y in own if y == label]) > 0.9


def test_rules_base_counts_on_all_documents(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert [quality_rules.base_counts(t) for t in texts] == [quality_rules.brute_force(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#$ \n\t\x1c\x85\u00e9\u2028", max_size=80))
def test_rules_base_counts_property(text):
    assert quality_rules.base_counts(text) == quality_rules.brute_force(text)


def test_rules_edge_cases(spark, make_docs, labels):
    docs = make_docs(ODD, "kept, n_words")
    out = {r.doc_id: r for r in quality_rules.apply_rules(docs, labels).collect()}
    assert len(out) == len(ODD)
    assert out[0].base_failed and out[0].n_words == 0 and not out[0].kept
    assert out[4].base_failed and out[4].n_repeat_words == 120
    assert quality_rules.apply_rules(docs.limit(0), labels).count() == 0
    free = quality_rules.apply_rules(docs, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in free)


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x", "http://example.org/es", "x://org/", "x://com/fr/a",
        "http://m.com/de/", "http://free-deal.net/", "http://a.net/free", "http://carefree-casinos.net/", "http://casino.net",
        "http://example.org/en/17#f", "http://notorg/", "http://a.net?free#win", "http://a.net/\nfree_win"]


def test_urls(spark, sf):
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(URLS)],
                                  "page_id long, url string, html string, rule string")
    out = {r.page_id: r for r in url_filter.filter_urls(pages.union(pages)).collect()}
    assert [out[i].verdict for i in range(len(URLS))] == [
        "allow", "allow", "allow", "allow", "block", "allow", "allow", "allow", "block", "block", "allow", "allow", "block",
        "block", "allow", "block", "block"]
    assert out[4].host == "a.example.org" and out[4].path == "/es/1" and out[4].rule == "example.org/es/"
    assert out[5].rule == "org/" and out[13].rule == "example.org/en/1" and out[14].rule is None
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_urls_match_sql(spark, tmp_path):
    import duckdb

    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", list(enumerate(URLS)))
    got = url_filter.filter_urls(spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string"))
    rel = con.sql(url_filter.oracle())
    assert sorted(map(tuple, got.select(*rel.columns).collect())) == sorted(rel.fetchall())


def test_vocabulary_is_the_plain_search():
    import re

    voc = url_filter.Vocabulary()
    for u in [u for u in URLS if u] + ["a-free.win/xxx", "freefree", "pills.pills"]:
        low = u.lower()
        plain = [sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in ts)
                 for ts in (url_filter.STRICT, url_filter.SOFT)]
        assert list(voc.hits(u)) == plain


def test_labelled_sample_has_one_row_an_id(spark, make_docs):
    from stationlake.llm.common import labelled_sample

    docs = make_docs([(i, f"text {i}") for i in range(60)] + [(8, f"again {i}") for i in range(100)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality long")
    ids = [i for i in range(60) if crc32(str(i).encode()) % 3 != 1]
    got = [labelled_sample(docs.repartition(n), labels, ["text", "n_chars"], 1000).collect() for n in (1, 5)]
    assert sorted(r.doc_id for r in got[0]) == ids and set(got[0]) == set(got[1])
    assert all(r.label == r.doc_id % 2 and r.n_chars == len(r.text) for r in got[0])
    assert 8 in ids and len(labelled_sample(docs, labels, ["text"], 20).collect()) == 20
