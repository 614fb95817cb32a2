"""Quality rules: base counts, and a calibrated logistic regression on hashed n-grams.

Base counts of a whole text: words, their code points, symbols, repeated lines and words in
repeated three-word windows.  A document that passes the two fixed base limits is judged by
a logistic regression on hashed words and hashed character 3- and 4-grams, A-Z lower-cased (each block
a mean over the text), calibrated on rows that the regression has not seen (Platt scaling)
and held against the fixed threshold ``THRESHOLD``.

Training: at most ``fit_rows`` labelled rows whose crc32 fold modulo 3 is not 1 (the first by
a hash of the id), the only bound; one in five of them calibrates.  Scoring runs in Arrow
batches over all whole texts.

Edge cases: a null or empty text has no words and fails the base rules; repeated rows get
equal verdicts; an empty table gives an empty result; without labels of both classes every
document that passes the base rules is kept.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import forget, in_slices, labelled_sample

WORD_BINS = 1 << 14
GRAM_BINS = 1 << 13
GRAMS = (3, 4)
SIZE = WORD_BINS + len(GRAMS) * GRAM_BINS
FIT_ROWS = 3000
EPOCHS = 12
THRESHOLD = 0.5
SPACE = " \t\n\v\f\r"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SYMBOLS = "#*$%&|<>"  # fixed values of the contract
MIN_WORDS, MAX_REPEATED = 50, 50  # fixed values of the contract
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(toks: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(toks)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    c = np.fromiter((codes.setdefault(t, len(codes)) for t in toks), np.int64, n)
    if len(codes) == n:
        return 0
    pair = c[:-1] * len(codes) + c[1:]
    if len(codes) > 1 << 20:  # keep the third factor inside 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(codes) + c[2:]
    _, inv, cnt = np.unique(window, return_inverse=True, return_counts=True)
    at = np.flatnonzero(cnt[inv] > 1)
    seen = np.zeros(n, bool)
    for k in range(3):
        seen[at + k] = True
    return int(seen.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    toks = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(toks), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(toks))


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEATED * n_words


def grams(text: str) -> list[np.ndarray]:
    """Bins of the words and of the character n-grams (by code points), one array a block."""
    low = text.translate(LOWER)
    toks = low.encode("utf-8", "surrogatepass").split()
    out = [np.fromiter(map(crc32, toks), np.uint32, len(toks)) & np.uint32(WORD_BINS - 1)]
    data = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    for k, n in enumerate(GRAMS):
        h = np.zeros(max(0, len(data) - n + 1), np.uint32)
        for i in range(n):
            h = h * np.uint32(0x01000193) + data[i:len(data) - n + 1 + i] if len(h) else h
        h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - (GRAM_BINS.bit_length() - 1))
        out.append(h + np.uint32(WORD_BINS + k * GRAM_BINS))
    return out


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sparse input: each block's bins with their share of the block."""
    idx, val = [], []
    for block in grams(text):
        if len(block):
            i, c = np.unique(block, return_counts=True)
            idx.append(i.astype(np.int32))
            val.append(np.sqrt(c / len(block)).astype(np.float32))
    if not idx:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(idx), np.concatenate(val)


@dataclass
class CalibratedRegression:
    """Weights of the bins, then slope and shift of the calibration."""

    w: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, x: tuple[np.ndarray, np.ndarray]) -> float:
        return float(self.w[x[0]] @ x[1]) + self.bias

    def probability(self, text: str) -> float:
        z = self.slope * self.logit(vector(text)) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(xs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11,
        rate: float = 0.03, decay: float = 1e-4, batch: int = 64) -> CalibratedRegression | None:
    """Regression on four rows of five, calibration on the fifth; None without both classes."""
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(xs))
    own, cal = order[len(xs) // 5:], order[:len(xs) // 5]
    model = CalibratedRegression(np.zeros(SIZE))
    m, u, mb, ub, step = np.zeros(SIZE), np.zeros(SIZE), 0.0, 0.0, 0
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs) + 1e-4
        own = rng.permutation(own)
        for at in range(0, len(own), batch):
            rows = own[at:at + batch]
            g = np.array([1 / (1 + np.exp(-np.clip(model.logit(xs[r]), -30, 30))) - y[r] for r in rows]) / len(rows)
            idx = np.concatenate([xs[r][0] for r in rows])
            grad = np.bincount(idx, np.concatenate([g[k] * xs[r][1] for k, r in enumerate(rows)]), SIZE)
            grad += decay * model.w
            step += 1
            m, u = 0.9 * m + 0.1 * grad, 0.999 * u + 0.001 * grad * grad
            mb, ub = 0.9 * mb + 0.1 * g.sum(), 0.999 * ub + 0.001 * g.sum() ** 2
            a, b = 1 - 0.9 ** step, 1 - 0.999 ** step
            model.w -= lr * (m / a) / (np.sqrt(u / b) + 1e-8)
            model.bias -= lr * (mb / a) / (np.sqrt(ub / b) + 1e-8)
    if len(set(y[cal].tolist())) < 2:
        cal = order
    z = np.array([model.logit(xs[r]) for r in cal])
    t = np.where(y[cal] == 1, (y[cal].sum() + 1) / (y[cal].sum() + 2), 1 / ((1 - y[cal]).sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(100):  # Newton steps on two parameters
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        w, r = p * (1 - p) + 1e-9, p - t
        h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        d = np.linalg.solve(h, np.array([(r * z).sum(), r.sum()]))
        slope, shift = slope - np.clip(d[0], -1, 1), shift - np.clip(d[1], -1, 1)
        if abs(d).max() < 1e-7:
            break
    model.slope, model.shift = max(float(slope), 1e-3), float(shift)
    return model


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> CalibratedRegression | None:
    """Fit on at most ``fit_rows`` labelled training rows; the executors make their vectors."""
    sample = labelled_sample(docs, labels, ["text"], fit_rows).select("text", "label")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [vector(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.astype("<u2").tobytes() for i, _ in xs], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for _, x in xs], pa.binary()),
                 b.column(1).cast(pa.int32())], names=["idx", "val", "label"])

    rows = sorted((bytes(r.idx), bytes(r.val), r.label)
                  for r in sample.mapInArrow(made, "idx binary, val binary, label int").collect())
    xs = [(np.frombuffer(i, "<u2").astype(np.int32), np.frombuffer(v, "<f4")) for i, v, _ in rows]
    return fit(xs, np.array([x[2] for x in rows], np.float64))


def judge(text: str | None, model: CalibratedRegression | None, threshold: float = THRESHOLD) -> tuple:
    """The base counts, base_failed, the calibrated probability and kept."""
    counts = base_counts(text)
    failed = base_failed(counts[0], counts[4])
    p = model.probability(text) if model and text else 0.5
    return (*counts, failed, p, not failed and (model is None or p >= threshold))


def apply_rules(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS,
                threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, probability and kept of every document."""
    model = train(docs, labels, fit_rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"]
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in in_slices(batches):
            out = [judge(t, model, threshold) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([o[k] for o in out], t) for k, t in enumerate(types))],
                names=["doc_id", *names])

    schema = f"doc_id {id_type}, {BASE}, base_failed boolean, probability double, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(judged, schema)


def brute_force(text: str | None) -> tuple[int, int, int, int, int]:
    """The base counts by plain loops, for tests."""
    t = text or ""
    toks = [w for w in "".join(" " if c in SPACE else c for c in t).split(" ") if w]
    wins = Counter(tuple(toks[i:i + 3]) for i in range(len(toks) - 2))
    hit = {i + k for i in range(len(toks) - 2) if wins[tuple(toks[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if any(c not in SPACE for c in line):
            dup += line in seen
            seen.add(line)
    return len(toks), sum(map(len, toks)), sum(c in SYMBOLS for c in t), dup, len(hit)
