"""The pipeline against a brute-force version, stage by stage, and its edge cases."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from stationlake.llm import mixing, quality_fm, secrets
from stationlake.llm.common import staged

from test_mixing import by_sql
from test_secrets import brute as brute_spans
from test_trie_join import brute as brute_groups

SF = "/root/testdata/sf0.01"


def kept_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, docs.collect()
    stages = dict(corpus_pipeline.STAGES)

    model = quality_fm.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = model.scores([r.text for r in given], [r.n_chars for r in given])
    want = [r for r, s in zip(given, scores, strict=True) if s >= 0.5]
    docs = staged(stages["quality classifier"](spark, docs, SF), "t")
    assert docs.columns == columns and kept_rows(docs) == sorted(map(tuple, want), key=repr)
    assert 0 < len(want) < len(given)

    groups = brute_groups([(r.doc_id, r.text) for r in want])
    least = {d for d, n, c in groups if d == c or not n}
    want = [r for r in want if r.doc_id in least]
    docs = staged(stages["n-gram jaccard join"](spark, docs, SF), "t")
    assert docs.columns == columns and kept_rows(docs) == sorted(map(tuple, want), key=repr)
    assert len(want) < len(groups)

    net = secrets.train(staged(secrets.scan(docs), "t"))
    docs = staged(stages["secret scans"](spark, docs, SF), "t")
    after = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and len(after) == len(want)
    hit = 0
    for r in want:
        spans = sorted((a, b) for _, a, b in brute_spans(r.text) + net.found(r.text or "", secrets.base_spans(r.text or "")))
        text, at = "", 0
        for a, b in spans:
            text += r.text[at:a] + "[SECRET]" if a >= at else ""
            at = max(at, b)
        text += (r.text or "")[at:]
        hit += bool(spans)
        assert after[r.doc_id].text == (text if r.text is not None else None)
        assert after[r.doc_id].n_chars == (len(text) if spans else r.n_chars)
    assert hit

    taken = {d: t // size for d, size, _, _, t in by_sql([(r.doc_id, r.text, r.source) for r in after.values()],
                                                         mixing.BLOCK_DOCS).fetchall() if size}
    docs = staged(stages["mixing sources"](spark, docs, SF), "t")
    assert docs.columns == columns
    assert Counter(r.doc_id for r in docs.collect()) == Counter({d: n for d, n in taken.items() if n})

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, n in taken.items():
        ids = tok.encode(after[d].text, add_special_tokens=False).ids
        decoded = tok.decode(ids, skip_special_tokens=False)
        want += [(d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(decoded.encode()).hexdigest())] * n
    out = corpus_pipeline.run(spark, SF)
    assert kept_rows(out) == sorted(want, key=repr)


def test_odd_tables(spark, make_docs, tmp_path):
    rows = [None, "", " ", "one", "one", ("x", "y"), "good plain words in a row " * 9, "good plain words in a row " * 9]
    rows = [(i, r, "s%d" % (i % 2)) for i, r in enumerate(r for r in rows if not isinstance(r, tuple))]
    rows += [(3, "one", None), (None, "words without an id", "s0"), (None, None, None)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, table in (("full", make_docs(rows, "cls, size, rank, score")), ("none", make_docs([]))):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        for stage, f in corpus_pipeline.STAGES[:-1]:
            docs = staged(f(spark, docs, str(tmp_path)), "t")
            assert docs.columns == table.columns, stage
        out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert (len(out) > 0) == (name == "full")


def test_entry_lists_everything():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [n for n in names if n.startswith("op") or n == "pipeline"] == [
        "op1_secrets", "op2_token_ids", "op3_lm_score", "op4_quality_classifier", "op5_jaccard_join", "op6_url_filters",
        "op7_bpe", "op8_mixing", "op9_topk", "op10_quality_rules", "op11_html_extraction", "op12_prefix_trie", "op13_collocations", "pipeline"]
    assert {"op6_url_filters", "op8_mixing", "op9_topk", "op12_prefix_trie", "op13_collocations"} <= set(entry.oracle_sql())
