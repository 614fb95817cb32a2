"""Operator 3: base scores against brute force; the network's probabilities, gradients and held-out gain; edge cases."""

from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from stationlake.llm import gru_lm, queries

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\v\f\r"


def split(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in "".join(" " if c in SPACE else c for c in low).split(" ") if w] + [None]


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, N, base) of each row."""
    held = [crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows]
    c = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in split(t))
    n, v = sum(c.values()), len(c)
    out = []
    for (d, t), h in zip(rows, held, strict=True):
        toks = split(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks)
        out.append((d, h, len(toks), sum(w in c for w in toks), n, round(base, 6)))
    return sorted(out, key=repr)


def result(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)


def test_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op3_lm_score(spark, SF).collect()
    assert result(rows) == brute(docs)
    assert all(r.score < 0 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)  # log: nearer to 0 is better


def model(seed=2, words=40, scale=5.0):
    rng = np.random.default_rng(seed)
    top = [(int(h), int(c)) for h, c in zip(rng.integers(1, 2 ** 63, words), rng.integers(1, 90, words), strict=True)]
    voc = gru_lm.Vocabulary.of(sum(c for _, c in top) + 300, words + 50, top, words, 5)
    m = gru_lm.Model(voc, gru_lm.Weights.start(voc, seed=seed))
    for a in m.w.arrays():
        a *= scale
    return m


def sequences(m, lengths, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for n in lengths:
        h = np.append(rng.choice(np.append(m.voc.hashes, np.uint64(7)), n - 1), gru_lm.END)
        out.append(gru_lm.prepared(m.voc, [h], np.full(n, 3))[0])
    return out


def test_probabilities_add_up_to_one():
    m = model()
    hs = np.random.default_rng(1).normal(size=(4, gru_lm.HIDDEN)).astype(np.float32)
    total = np.zeros(4)
    for h in m.voc.hashes:
        _, c, p = m.voc.look_up(np.array([h]))
        total += np.exp(m.log_probabilities(hs, np.repeat(c, 4), np.repeat(p, 4), np.zeros(4, np.float32)))
    last = len(m.voc.members)
    total += np.exp(m.log_probabilities(hs, np.full(4, last), np.zeros(4, int), np.zeros(4, np.float32)))
    assert total == pytest.approx(np.ones(4), abs=1e-4)
    # inside the last class: all other training tokens and one unknown share the smoothed counts
    known = [30, 40, 50]
    voc = gru_lm.Vocabulary.of(120 + 10, 3 + 4, [(i + 1, c) for i, c in enumerate(known)] + [(int(gru_lm.END), 0)], 4, 3)
    assert voc.rare == pytest.approx(10 + 0.1 * 4 + 0.1)


def test_score_does_not_depend_on_windows_or_lanes():
    m = model()
    docs = sequences(m, [1, 5, 70, 33, 2, 1, 200])
    want = m.score(docs, window=10 ** 6, count=1)
    for window, count in ((1, 3), (16, 2), (32, 256)):
        assert m.score(docs, window, count) == pytest.approx(want, rel=1e-4)


def test_gradients_are_the_slopes():
    m = model(scale=2.0)
    for f in ("embed", "wx", "wh", "b", "oc", "ow"):
        setattr(m.w, f, getattr(m.w, f).astype(np.float64))
    docs = sequences(m, [9, 4, 6, 3])
    s = gru_lm.Stream.of(docs, 2, m.end)
    k, sl = s.x.shape[1], slice(0, len(s.x))
    h0 = np.zeros((k, gru_lm.HIDDEN))

    def loss():
        hs = m.states(m.w.embed[s.x] @ m.w.wx + m.w.b, s.fresh, h0).astype(np.float64)
        real = np.flatnonzero(s.doc.ravel() >= 0)
        return -m.log_probabilities(hs.reshape(-1, gru_lm.HIDDEN)[real], s.cls.ravel()[real], s.place.ravel()[real],
                                    np.zeros(len(real))).mean()

    _, grads = m.gradients(s, sl, k, h0)
    rng = np.random.default_rng(4)
    for p, g in zip(m.w.arrays(), grads, strict=True):
        d = rng.normal(size=p.shape)
        p += 1e-3 * d
        up = loss()
        p -= 2e-3 * d
        down = loss()
        p += 1e-3 * d
        assert float((g * d).sum()) == pytest.approx((up - down) / 2e-3, rel=0.03, abs=2e-4)


def test_training_learns_a_rule():
    """Each word tells the next one: far better than frequencies alone."""
    rng = np.random.default_rng(6)
    top = [(i + 1, 100) for i in range(8)] + [(int(gru_lm.END), 50)]
    voc = gru_lm.Vocabulary.of(900, 9, top, 9, 4)
    m = gru_lm.Model(voc, gru_lm.Weights.start(voc))
    chains = [np.append((np.arange(12) + rng.integers(8)) % 8 + 1, gru_lm.END).astype(np.uint64) for _ in range(400)]
    docs = gru_lm.prepared(voc, chains)
    before = m.score(docs[:50]).sum()
    for _ in range(3):
        m.train(docs[50:], 0.02)
    assert m.score(docs[:50]).sum() > 0.4 * before


ODD = [None, "", " ", "One one ONE", "one two", "É é", "a" * 5000, "w " * 9000, "same text", "same text"]


def test_edge_cases(spark, make_docs):
    rows = [*enumerate(ODD), (3, "again"), (None, "no id"), (None, None)]
    out = gru_lm.score_documents(make_docs(rows, "score, p, held_out, n"), words=20).collect()
    assert result(out) == brute(rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out)
    assert len({round(r.score, 6) for r in out if r.doc_id in (8, 9)}) == 1
    assert gru_lm.score_documents(make_docs([])).count() == 0
    held = next(i for i in range(100) if crc32(str(i).encode()) % 10 == 0)
    alone = gru_lm.score_documents(make_docs([(held, "no training at all")])).collect()
    assert result(alone) == brute([(held, "no training at all")]) and alone[0].base_score == 0


def test_lanes_hold_every_document_once():
    lens = np.array([5, 1, 9, 2, 2, 7])
    dealt = gru_lm.lanes(lens, 3)
    assert sorted(d for lane in dealt for d in lane) == list(range(6))
    totals = [int(lens[lane].sum()) for lane in dealt]
    assert totals == sorted(totals, reverse=True) and max(totals) <= 10


def vocabulary_of(parts):
    return gru_lm.vocabulary(gru_lm.corpus_counts(parts, 20), 20)


def test_the_fitted_share_is_constant_and_rounds_are_disjoint(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('w', id) AS text")
    for n in (300, 1500, 6000):
        parts = gru_lm.parted(docs.where(f"doc_id < {n}"))
        got = [(r.h, r["round"]) for r in gru_lm.dealt_rounds(parts, vocabulary_of(parts), 1 / 6, 4).collect()]
        train = sum(crc32(str(i).encode()) % 10 != 0 for i in range(n))
        assert len(got) == len({h for h, _ in got}) == len(set(got)) and {i for _, i in got} == {0, 1, 2, 3}
        assert len(got) / train == pytest.approx(1 / 6, rel=0.35 if n == 300 else 0.15)
    everything = gru_lm.dealt_rounds(parts, vocabulary_of(parts), 1.0)
    assert everything.count() == train


def test_repeated_rows_are_fitted_on_once(spark, make_docs):
    parts = gru_lm.parted(make_docs([(1, "a b"), (2, "c")]).union(make_docs([(3, "x y z")] * 50)))
    rows = gru_lm.dealt_rounds(parts, vocabulary_of(parts), 1.0).collect()
    assert len(rows) == sum(crc32(str(i).encode()) % 10 != 0 for i in (1, 2, 3))


def test_parts_hold_every_token_and_are_bounded(spark, make_docs, monkeypatch):
    monkeypatch.setattr(gru_lm, "PART", 3)
    monkeypatch.setattr(gru_lm, "TOKENS", 40)
    texts = ["a b c", None, "w " * 100, "d", "", "e f", "g " * 30, "h " * 12, "i"]
    parts = gru_lm.parted(make_docs(list(enumerate(texts))).coalesce(1)).collect()
    found = {}
    for r in parts:
        values, numbers = gru_lm.unpack(r.vals), gru_lm.unpack_numbers(r.numbers)
        assert len(r.ids) <= 3 and sum(r.lens[:-1]) < 40  # closed by its last document
        for d, (own,) in zip(r.ids, gru_lm.cut_up(np.array(r.lens), values[numbers]), strict=True):
            found[d] = own.tolist()
    assert found == {i: gru_lm.tokens(t).tolist() for i, t in enumerate(texts)}


def test_an_unfitted_model_gives_the_base_score():
    rng = np.random.default_rng(3)
    top = [(int(h), int(c)) for h, c in zip(rng.integers(1, 2 ** 62, 30), rng.integers(1, 90, 30), strict=True)] + [(int(gru_lm.END), 25)]
    n, v = sum(c for _, c in top) + 70, 31 + 20
    voc = gru_lm.Vocabulary.of(n, v, top, 31, 5)
    m = gru_lm.Model(voc, gru_lm.Weights.start(voc))
    for a in (m.w.oc, m.w.ow):
        a[:-1] = 0
    counts = np.array([dict(top)[int(h)] for h in voc.hashes] + [4, 0])  # a rarer token and an unknown one
    hashes = np.append(voc.hashes, [np.uint64(5), np.uint64(6)])
    want = np.log10((counts + 0.1) / (n + 0.1 * (v + 1))).sum()
    assert m.score(gru_lm.prepared(voc, [hashes], counts))[0] == pytest.approx(want, rel=1e-5)


def test_every_training_document_is_fitted_on(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('w', id) AS text")
    parts = gru_lm.parted(docs)
    rows = gru_lm.dealt_rounds(parts, vocabulary_of(parts)).collect()
    assert len(rows) == sum(crc32(str(i).encode()) % 10 != 0 for i in range(400))


def test_lanes_of_a_pass_leave_steps():
    assert gru_lm.lanes_for(10) == gru_lm.LANES and gru_lm.lanes_for(10 ** 9) == gru_lm.FIT_LANES
    for n in (200_000, 500_000):
        assert n // (gru_lm.lanes_for(n) * gru_lm.WINDOW) >= gru_lm.STEPS


def test_tokens_are_numbered_and_summed_without_sorting_them_all():
    rng = np.random.default_rng(8)
    for toks in (rng.integers(0, 2 ** 64, 50, np.uint64)[rng.integers(0, 50, 400)], np.array([gru_lm.END])):
        values, numbers = gru_lm.numbered(toks)
        want, inverse = np.unique(toks, return_inverse=True)
        assert values.dtype == np.uint64 and values.tolist() == want.tolist() and numbers.tolist() == inverse.tolist()
    columns, x = rng.normal(size=(3, 200)).astype(np.float32), rng.integers(0, 9, 200).astype(np.int32)
    want = np.zeros((11, 3), np.float32)
    np.add.at(want, x, columns.T)
    assert gru_lm._summed(columns, x, 11) == pytest.approx(want, abs=1e-4)


def test_lanes_lie_last_in_memory():
    m = model()
    one = m.run(np.zeros((3 * gru_lm.HIDDEN, 4, 32), np.float32), np.zeros((4, 32), bool), np.zeros((gru_lm.HIDDEN, 32), np.float32))
    assert one.shape == (gru_lm.HIDDEN + 1, 4, 32) and one.flags.c_contiguous and (one[-1] == 1).all()
