"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's input is a sparse vector: its distinct lower-cased words hashed to ``WORD_BINS``
bins (square roots of their counts, scaled to length one), ``STRUCTURE`` statistics of the
text, and the ``n_chars`` metadata.  The machine adds all pairwise interactions through
low-rank factors in linear time: sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2) / 2.

Training: at most ``fit_rows`` labelled rows whose crc32 fold modulo 3 is not 1 (the first by
a hash of the id), the only bound here; their sparse vectors are made by the executors and
the bounded set is fitted on the driver.  Scoring reads every whole text, in Arrow batches.

Edge cases: a null text is the empty text, whose vector holds the structure entries only and
is scored like any other; a null ``n_chars`` counts as 0; repeated rows get equal scores; an
empty document table gives an empty result; without labelled training rows, or with one class
only, the score is that of the class prior (0.5 without any label).  Label, lang, source and
doc_id never enter a score; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import fold, forget, in_slices, labelled_sample

WORD_BINS = 1 << 14
RANK = 4
FIT_ROWS = 6000
EPOCHS = 12
TOGETHER = 128  # documents whose vectors are held at a time
SYMBOLS = b"#*$%&|<>"

_KIND = np.zeros(256, np.uint8)  # of a byte: 1 upper, 2 lower, 3 digit, 4 symbol, 5 end mark, 6 other ASCII punctuation
_KIND[ord("A"):ord("Z") + 1], _KIND[ord("a"):ord("z") + 1], _KIND[ord("0"):ord("9") + 1] = 1, 2, 3
for _c in b"!\"'(),-./:;?@[\\]^_`{}~+=":
    _KIND[_c] = 6
for _c in b"!?":
    _KIND[_c] = 5
for _c in SYMBOLS:
    _KIND[_c] = 4

STRUCTURE = ["bias", "upper", "digits", "symbols", "marks", "punctuation", "non_ascii", "log_words", "word_bytes",
             "distinct", "repeated_lines", "log_lines", "top_word", "log_chars"]
SIZE = WORD_BINS + len(STRUCTURE)


def vector(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one document's sparse input."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    toks = raw.lower().split()
    n, size = len(toks), max(1, len(raw))
    if n:
        idx, cnt = np.unique(np.fromiter(map(crc32, toks), np.uint32, n) & np.uint32(WORD_BINS - 1), return_counts=True)
        val = np.sqrt(cnt)
        top = cnt.max() / n
        val = val / math.sqrt(n)
    else:
        idx, val, cnt, top = np.zeros(0, np.uint32), np.zeros(0), np.zeros(0), 0.0
    data = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(_KIND[data], minlength=7)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dense = [1.0, kinds[1] / size, kinds[3] / size, kinds[4] / size, kinds[5] / size, kinds[6] / size,
             np.count_nonzero(data >= 128) / size, math.log1p(n) / 10, min(1.0, size / max(1, n) / 20),
             len(idx) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)), math.log1p(len(lines)) / 8, top,
             math.log1p(min(10 ** 9, max(0, n_chars if n_chars is not None and n_chars == n_chars else 0))) / 12]
    return (np.concatenate([idx.astype(np.int32), np.arange(WORD_BINS, SIZE, dtype=np.int32)]),
            np.concatenate([val, dense]).astype(np.float32))


@dataclass
class FactorisationMachine:
    """w (linear) and v (factors) over the hashed inputs; ``prior`` is used where nothing could be learnt."""

    w: np.ndarray
    v: np.ndarray
    shift: float = 0.0

    def logits(self, idx: np.ndarray, val: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of documents whose sparse vectors lie one after the other and end at ``ends``; none is empty."""
        starts = np.concatenate([[0], ends[:-1]])
        vx = self.v[idx] * val[:, None]
        s, q = np.add.reduceat(vx, starts), np.add.reduceat(vx * vx, starts)
        return self.shift + np.add.reduceat(self.w[idx] * val, starts) + 0.5 * (s * s - q).sum(1)

    def scores(self, texts: list[str | None], chars: list[int | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        out = []
        for at in range(0, len(texts), TOGETHER):
            xs = [vector(t, c) for t, c in zip(texts[at:at + TOGETHER], chars[at:at + TOGETHER], strict=True)]
            out.append(self.logits(np.concatenate([i for i, _ in xs]), np.concatenate([x for _, x in xs]),
                                   np.cumsum([len(i) for i, _ in xs])))
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out).astype(np.float64), -30, 30)))


def fit(xs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS, rank: int = RANK,
        rate: float = 0.02, decay: float = 1e-5, seed: int = 7, batch: int = 64) -> FactorisationMachine:
    """Logistic loss, classes weighted evenly in part, Adam on the entries that a batch touches."""
    rng = np.random.default_rng(seed)
    model = FactorisationMachine(np.zeros(SIZE, np.float32), rng.normal(0, 0.05, (SIZE, rank)).astype(np.float32))
    n, pos = len(xs), float(np.sum(y))
    if n == 0 or pos in (0, n):
        p = 0.5 if n == 0 else (pos + 0.5) / (n + 1)
        model.v[:] = 0
        model.shift = math.log(p / (1 - p))
        return model
    theta = np.concatenate([model.w[:, None], model.v], 1)
    m, u = np.zeros_like(theta), np.zeros_like(theta)
    weight = np.where(y == 1, 1.0, math.sqrt(pos / (n - pos)))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        lr = rate * (1 - epoch / epochs) + 1e-4
        for at in range(0, n, batch):
            rows = order[at:at + batch]
            idx = np.concatenate([xs[r][0] for r in rows])
            val = np.concatenate([xs[r][1] for r in rows])
            lens = np.array([len(xs[r][0]) for r in rows])
            ends = np.cumsum(lens)
            model.w, model.v = theta[:, 0], theta[:, 1:]
            z = model.logits(idx, val, ends)
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            of = np.repeat(np.arange(len(rows)), lens)
            vx = model.v[idx] * val[:, None]
            s = np.add.reduceat(vx, np.concatenate([[0], ends[:-1]]))
            dv = g[of][:, None] * val[:, None] * (s[of] - vx)
            grad = np.concatenate([(g[of] * val)[:, None], dv], 1)
            seen, inv = np.unique(idx, return_inverse=True)
            total = np.stack([np.bincount(inv, grad[:, c], len(seen)) for c in range(rank + 1)], 1).astype(np.float32)
            total += decay * theta[seen]
            step += 1
            m[seen] = 0.9 * m[seen] + 0.1 * total
            u[seen] = 0.999 * u[seen] + 0.001 * total * total
            theta[seen] -= lr * (m[seen] / (1 - 0.9 ** step)) / (np.sqrt(u[seen] / (1 - 0.999 ** step)) + 1e-6)
    model.w, model.v = np.ascontiguousarray(theta[:, 0]), np.ascontiguousarray(theta[:, 1:])
    return model


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> FactorisationMachine:
    """Fit on at most ``fit_rows`` labelled training rows; the executors make their vectors."""
    sample = labelled_sample(docs, labels, ["text", "n_chars"], fit_rows).select("text", "n_chars", "label")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [vector(t, c) for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.astype("<i4").tobytes() for i, _ in xs], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for _, x in xs], pa.binary()),
                 b.column(2).cast(pa.int32())], names=["idx", "val", "label"])

    rows = sorted((bytes(r.idx), bytes(r.val), r.label)
                  for r in sample.mapInArrow(made, "idx binary, val binary, label int").collect())
    xs = [(np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4")) for i, v, _ in rows]
    return fit(xs, np.array([x[2] for x in rows], np.float64))


def keep_good(docs: DataFrame, model: FactorisationMachine, least: float = 0.5) -> DataFrame:
    """All columns of the documents that score ``least`` or more."""
    text, chars = docs.columns.index("text"), docs.columns.index("n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in in_slices(batches):
            yield b.filter(pa.array(model.scores(b.column(text).to_pylist(), b.column(chars).to_pylist()) >= least))

    return docs.mapInArrow(run, docs.schema)


def score_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, fit_rows)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in in_slices(batches):
            s = model.scores(b.column(2).to_pylist(), b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text", "n_chars").mapInArrow(
        scored, f"doc_id {id_type}, held_out boolean, score double, predicted int")
