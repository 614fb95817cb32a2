"""Scoring with a gated recurrent language model.

Tokens are lower-cased words (A-Z) and one end a document, as 64-bit hashes.  Texts are read once: each
task cuts its documents into parts (closed at ``PART`` documents or ``TOKENS`` tokens), and a part is written as its
distinct tokens, their training counts, and the number of every token among them; all that follows reads these
numbers.  The corpus side covers every training document (crc32 fold modulo 10 is not 0): each part sends its
distinct tokens with their counts to hash ranges, and a range answers each part with the total counts; N, V and the
most frequent tokens come from the same totals.  ``base_score`` is the sum of log10((c + 0.1) / (N + 0.1 * (V + 1))).

The model is a GRU over the ``WORDS`` most frequent tokens (all others share one input).  Its output
is factored: a softmax over classes of like total frequency, then one over the words of the
class; the last class holds all other tokens with their smoothed training frequencies (one
share for unknown ones), so the probabilities of all tokens add up to 1.  The output biases start at the
smoothed training frequencies, so that an unfitted model gives the base score.  Hidden states are
carried across windows of ``WINDOW`` tokens from a document's first to its last token.

Fitting the weights: truncated backpropagation over these windows in numpy, documents in pieces of ``PIECE``
tokens so that one long document does not steer the last steps alone, on every training document (``fit_share``
below 1 keeps only the share of them whose hash lies under it); rows that repeat both id and text are fitted on once.
``ROUNDS`` slices of the hash part them, so no document is seen twice.  A round deals
its slice to replicas of about ``REPLICA`` documents; every replica takes one pass with Adam from the
common weights, in up to ``FIT_LANES`` lanes where its tokens allow for ``STEPS`` steps (more lanes cost less a token), and the
replicas' weights are averaged (by tokens) in groups, so the driver sees few.

Edge cases: a null text is the empty text, whose only token is its end; a null id counts as the
empty text in the fold (held out); repeated rows get equal scores; without training documents N and V are 0, every
base term is log10(1) = 0, and the weights stay as they start; an empty table gives an empty result;
texts of any length are scored whole; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stationlake.llm.common import fold, in_slices, staged
from stationlake.llm.trie_join import lowered, pack, pack_counts, unpack, unpack_counts, word_hashes

PART, TOKENS = 2500, 1_500_000  # documents or tokens that close a part
RANGE = 2_000_000  # tokens a hash range
WORDS, CLASSES, EMBED, HIDDEN = 1000, 24, 16, 24
WINDOW, LANES = 16, 32
SCORE_WINDOW, SCORE_LANES, BLOCK = 32, 256, 32
FIT_SHARE, REPLICA, ROUNDS = 1.0, 2000, 4
FIT_LANES, STEPS = 256, 200
PIECE = 512  # tokens a fit runs through before the state starts anew, so that lanes end together
END = np.uint64(xxhash.xxh3_64_intdigest(b"\x00 end"))  # holds a blank, so no word has it


def tokens(text: str | None) -> np.ndarray:
    toks = lowered(text)
    out = np.empty(len(toks) + 1, np.uint64)
    out[:-1] = np.fromiter(map(word_hashes().__getitem__, toks), np.uint64, len(toks))
    out[-1] = END
    return out


def numbered(toks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens, ascending, and the place of every token among them; only the distinct ones are sorted."""
    codes, values = pd.factorize(toks)
    order = np.argsort(values)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return values[order], place[codes]


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers under 2^32 as byte planes, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_numbers(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


# ---- parts of the corpus and its counts

def parted(docs: DataFrame) -> DataFrame:
    """One row a part: p; ids, held, hs (a hash of id and text) and lens of its documents; vals, its distinct tokens, ascending;
    counts, their occurrences in its training documents; numbers, the place in vals of every token."""
    id_type = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", "text", (fold("doc_id", 10) == 0).alias("held"), F.xxhash64("doc_id", "text").alias("h"))
    columns = {"p": pa.int64(), "ids": pa.list_(to_arrow_type(id_type)), "held": pa.list_(pa.bool_()), "hs": pa.list_(pa.int64()),
               "lens": pa.list_(pa.int64()), "vals": pa.binary(), "counts": pa.binary(), "numbers": pa.binary()}

    def part(p: int, ids: list, held: list, hs: list, toks: list[np.ndarray]) -> pa.RecordBatch:
        lens = [len(t) for t in toks]
        values, numbers = numbered(np.concatenate(toks))
        counts = np.bincount(numbers[np.repeat(~np.array(held, bool), lens)], minlength=len(values))
        row = (p, ids, held, hs, lens, pack(values), pack_counts(counts), pack_numbers(numbers))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, columns.values(), strict=True)],
                                          names=list(columns))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, own, size = TaskContext.get().partitionId() << 32, ([], [], [], []), 0
        for b in in_slices(batches, 64):
            for doc, text, held, h in zip(*(c.to_pylist() for c in b.columns), strict=True):
                toks = tokens(text)
                for col, v in zip(own, (doc, held, h, toks), strict=True):
                    col.append(v)
                size += len(toks)
                if len(own[0]) >= PART or size >= TOKENS:
                    yield part(p, *own)
                    p, own, size = p + 1, ([], [], [], []), 0
        if own[0]:
            yield part(p, *own)

    return staged(rows.mapInArrow(cut, f"p long, ids array<{id_type.simpleString()}>, held array<boolean>, hs array<long>, "
                                       "lens array<long>, vals binary, counts binary, numbers binary"), "lm-parts")


def corpus_counts(parts: DataFrame, words: int = WORDS) -> DataFrame:
    """For every part and range the counts of the part's tokens, and (p null) each range's n, v and top tokens."""
    size = parts.agg(F.sum(F.expr("aggregate(lens, 0L, (a, n) -> a + n)"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE))

    def sent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for p, vals, counts in zip(f["p"], f["vals"], f["counts"], strict=True):
                values, counts = unpack(vals), unpack_counts(counts)
                of = ((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                cuts = np.searchsorted(of, np.arange(ranges + 1))
                out += [(r, p, pack(values[a:b]), pack_counts(counts[a:b]))
                        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            yield pd.DataFrame(out, columns=["r", "p", "vals", "counts"])

    def summed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        vals = [unpack(x) for x in frame["vals"]]
        counts = np.concatenate([unpack_counts(x) for x in frame["counts"]]).astype(np.int64)
        values, inv = np.unique(np.concatenate(vals), return_inverse=True)
        totals = np.bincount(inv, counts, len(values)).astype(np.int64)
        out, at = [], 0
        for p, v in zip(frame["p"], vals, strict=True):
            out.append((key[0], p, totals[inv[at:at + len(v)]].astype("<i8").tobytes(), 0, 0, None))
            at += len(v)
        top = np.lexsort((values, -totals))[:words]
        top = top[totals[top] > 0]
        out.append((key[0], None, totals[top].astype("<i8").tobytes(), int(totals.sum()), int((totals > 0).sum()),
                    values[top].astype("<u8").tobytes()))
        got = pd.DataFrame(out, columns=["r", "p", "counts", "n", "v", "top"])
        return got.astype({"p": "Int64"})

    return (parts.select("p", "vals", "counts").mapInPandas(sent, "r long, p long, vals binary, counts binary")
            .groupBy("r").applyInPandas(summed, "r long, p long, counts binary, n long, v long, top binary"))


@dataclass
class Vocabulary:
    """The corpus' totals, and the frequent tokens (sorted by hash) with their class and place in it."""

    n: int
    v: int
    hashes: np.ndarray
    totals: np.ndarray
    cls: np.ndarray
    place: np.ndarray
    members: list[int]  # words of each class but the last
    rare: float  # total smoothed count of the last class

    @classmethod
    def of(cls, n: int, v: int, top: list[tuple[int, int]], words: int = WORDS, classes: int = CLASSES) -> Vocabulary:
        """top: (hash, count) of the most frequent tokens; the end is always one of the words."""
        best = sorted(top, key=lambda x: (-x[1], x[0]))[:words]
        if all(h != int(END) for h, _ in best):
            best = best[:words - 1] + [(int(END), dict(top).get(int(END), 0))]
        share = np.cumsum([math.sqrt(c) for _, c in best])  # between equal size and equal total
        of = np.minimum((share / max(share[-1], 1e-9) * (classes - 1) - 1e-9).astype(np.int64), classes - 2)
        of = np.unique(of, return_inverse=True)[1]
        members = np.bincount(of).tolist()
        place = np.concatenate([np.arange(m) for m in members])
        hashes, totals = np.array([h for h, _ in best], np.uint64), np.array([c for _, c in best], np.float64)
        order = np.argsort(hashes)
        known = sum(c for _, c in best)
        rare = n - known + 0.1 * (v - sum(c > 0 for _, c in best) + 1)
        return cls(n, v, hashes[order], totals[order], of[order], place[order], members, rare)

    def inputs(self, values: np.ndarray) -> np.ndarray:
        """Input numbers of token hashes (the last: any other token)."""
        at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        return np.where(self.hashes[at] == values, at, len(self.hashes))

    def outputs(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and place of input numbers."""
        return np.append(self.cls, len(self.members))[inputs], np.append(self.place, 0)[inputs]

    def look_up(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input number, class and place of token hashes."""
        x = self.inputs(values)
        return x, *self.outputs(x)

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Log shares of the classes, and of the words (side by side by class) in their class."""
        sums = np.bincount(self.cls, self.totals + 0.1, len(self.members))
        first = np.concatenate([[0], np.cumsum(self.members)])
        word = np.empty(len(self.hashes))
        word[first[self.cls] + self.place] = np.log((self.totals + 0.1) / sums[self.cls])
        share = np.append(sums, self.rare)
        return np.log(share / share.sum()), word


# ---- the network

@dataclass
class Weights:
    embed: np.ndarray  # (words + 1, EMBED)
    wx: np.ndarray  # (EMBED, 3 HIDDEN): reset, update, candidate
    wh: np.ndarray  # (HIDDEN, 3 HIDDEN)
    b: np.ndarray  # (3 HIDDEN,)
    oc: np.ndarray  # (HIDDEN + 1, classes)
    ow: np.ndarray  # (HIDDEN + 1, words): side by side by class

    @classmethod
    def start(cls, voc: Vocabulary, seed: int = 1) -> Weights:
        rng = np.random.default_rng(seed)
        k = len(voc.hashes)
        r = lambda *s, a=0.1: rng.normal(0, a, s).astype(np.float32)
        own = cls(r(k + 1, EMBED), r(EMBED, 3 * HIDDEN, a=0.2), r(HIDDEN, 3 * HIDDEN, a=0.2),
                  np.zeros(3 * HIDDEN, np.float32), r(HIDDEN + 1, len(voc.members) + 1, a=0.02), r(HIDDEN + 1, k, a=0.02))
        own.oc[-1], own.ow[-1] = voc.biases()
        return own

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def pack(self) -> bytes:
        return b"".join(a.astype("<f4").tobytes() for a in self.arrays())

    def unpack(self, raw: bytes) -> Weights:
        out, at = [], 0
        for a in self.arrays():
            out.append(np.frombuffer(raw, "<f4", a.size, at).reshape(a.shape).copy())
            at += 4 * a.size
        return Weights(*out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _softmax(z: np.ndarray) -> np.ndarray:
    """Of every column, in place."""
    z -= z.max(0)
    np.exp(z, out=z)
    z /= z.sum(0)
    return z


def _log_chosen(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-softmax of one entry a column; z is overwritten."""
    z -= z.max(0)
    out = z[at, np.arange(len(at))]
    return out - np.log(np.exp(z, out=z).sum(0))


def _summed(columns: np.ndarray, x: np.ndarray, count: int) -> np.ndarray:
    """The sums of the columns of like number: (count, rows)."""
    order = np.argsort(x.astype(np.int16) if count < 1 << 15 else x, kind="stable")
    own = x[order]
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    out = np.zeros((count, len(columns)), columns.dtype)
    out[own[starts]] = np.add.reduceat(np.take(columns, order, 1), starts, 1).T
    return out


def lanes(lengths: np.ndarray, count: int) -> list[list[int]]:
    """Documents dealt to lanes of like total length, longest lane first."""
    heap = [(0, i) for i in range(max(1, min(count, len(lengths))))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable"):
        n, i = heap[0]
        out[i].append(int(d))
        heapq.heapreplace(heap, (n + int(lengths[d]), i))
    return sorted(out, key=lambda x: -int(lengths[x].sum()) if x else 0)


@dataclass
class Stream:
    """Documents side by side in lanes: a token's input, class, place, static log-probability and document."""

    x: np.ndarray
    cls: np.ndarray
    place: np.ndarray
    static: np.ndarray
    doc: np.ndarray
    fresh: np.ndarray  # the first token of a document: the state starts anew
    active: np.ndarray  # lanes that are not over at each step

    @classmethod
    def of(cls, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], count: int, end: int, block: int = 1) -> Stream:
        """docs: (input numbers, classes, places, static) of each document's tokens. Empty lanes fill the last ``block``."""
        lens = np.array([len(d[0]) for d in docs], np.int64)
        dealt = lanes(lens, count)
        totals = np.array([int(lens[d].sum()) for d in dealt], np.int64)
        steps = int(totals.max(initial=0))
        shape = (steps, -(-len(dealt) // block) * block)
        out = cls(np.full(shape, end, np.int32), np.zeros(shape, np.int16), np.zeros(shape, np.int32),
                  np.zeros(shape, np.float32), np.full(shape, -1, np.int64), np.zeros(shape, bool),
                  (totals[None, :] > np.arange(steps)[:, None]).sum(1))
        for lane, own in enumerate(dealt):
            at = 0
            for d in own:
                x, c, p, s = docs[d]
                sl = slice(at, at + len(x))
                out.x[at + 1:at + len(x), lane] = x[:-1]  # the input is the token before; the first one's is the end
                out.cls[sl, lane], out.place[sl, lane], out.static[sl, lane], out.doc[sl, lane] = c, p, s, d
                out.fresh[at, lane] = True
                at += len(x)
        return out


class Model:
    """In memory the lanes come last, so every operation of a step runs over whole rows of lanes."""

    def __init__(self, voc: Vocabulary, weights: Weights) -> None:
        self.voc, self.w = voc, weights
        self.first = np.concatenate([[0], np.cumsum(voc.members)])

    def table(self) -> np.ndarray:
        """Input gates (3 HIDDEN) of every input number: one product for each word, not for each token."""
        out = self.w.wx.T @ self.w.embed.T
        out += self.w.b[:, None]
        return out

    def run(self, gates: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states and a row of ones (HIDDEN + 1, steps, lanes) from the input gates; h (HIDDEN, lanes) is the state before."""
        n = HIDDEN
        one = np.ones((n + 1, *gates.shape[1:]), np.float32)
        w_ru, w_c = self.w.wh[:, :2 * n].T.copy(), self.w.wh[:, 2 * n:].T.copy()
        begins, stay = fresh.any(1), (~fresh).astype(np.float32)
        for t in range(gates.shape[1]):
            if begins[t]:
                h = h * stay[t]
            ru = w_ru @ h
            ru += gates[:2 * n, t]
            r, u = _sigmoid(ru)[:n], ru[n:]
            rh = r * h
            c = w_c @ rh
            c += gates[2 * n:, t]
            np.tanh(c, out=c)
            new = h - c
            new *= u
            new += c
            if keep is not None:
                keep.append((h, r, u, rh, c))
            one[:n, t] = h = new
        return one

    def states(self, gates: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Hidden states (steps, lanes, HIDDEN) from input gates (steps, lanes, 3 HIDDEN); h (lanes, HIDDEN) is the state before."""
        return self.run(gates.transpose(2, 0, 1), fresh, h.T)[:-1].transpose(1, 2, 0)

    def by_class(self, cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice, slice]]]:
        """The tokens' order by class, and the classes of several words: where their tokens and words lie."""
        order = np.argsort(cls.astype(np.int16), kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(len(self.voc.members) + 1))
        return order, [(k, slice(cuts[k], cuts[k + 1]), slice(self.first[k], self.first[k + 1]))
                       for k, m in enumerate(self.voc.members) if m > 1 and cuts[k] < cuts[k + 1]]

    def log_chosen(self, one: np.ndarray, cls: np.ndarray, place: np.ndarray, static: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of the tokens given the hidden states and a row of ones (columns)."""
        order, classes = self.by_class(cls)
        own, place = np.take(one, order, 1), place[order]
        got = _log_chosen(self.w.oc.T @ own, cls[order])
        for _, rows, part in classes:
            got[rows] += _log_chosen(self.w.ow[:, part].T @ own[:, rows], place[rows])
        out = np.empty(len(cls), got.dtype)
        out[order] = got
        return out + static

    def log_probabilities(self, hs: np.ndarray, cls: np.ndarray, place: np.ndarray, static: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of the tokens given the hidden states (rows)."""
        return self.log_chosen(np.concatenate([hs, np.ones((len(hs), 1), np.float32)], 1).T, cls, place, static)

    def score(self, docs: list, window: int = SCORE_WINDOW, count: int = SCORE_LANES) -> np.ndarray:
        """log10 probability of each document. Lanes are filled up to whole ``BLOCK``s: a matrix product of another number of rows
        may round otherwise, which can grow from state to state."""
        s = Stream.of(docs, count, self.end, BLOCK)
        table = self.table()
        total = np.zeros(len(docs))
        h = np.zeros((HIDDEN, s.x.shape[1]), np.float32)
        for lo in range(0, len(s.x), window):
            sl = slice(lo, lo + window)
            k = -(-int(s.active[lo]) // BLOCK) * BLOCK  # lanes are in order of length
            one = self.run(np.take(table, s.x[sl, :k], 1), s.fresh[sl, :k], h[:, :k])
            h = one[:-1, -1]
            doc = s.doc[sl, :k].ravel()
            real = np.flatnonzero(doc >= 0)
            one = one.reshape(HIDDEN + 1, -1)
            p = self.log_chosen(one if len(real) == len(doc) else np.take(one, real, 1), s.cls[sl, :k].ravel()[real],
                                s.place[sl, :k].ravel()[real], s.static[sl, :k].ravel()[real])
            total += np.bincount(doc[real], p.astype(np.float64), len(docs))
        return total / math.log(10)

    @property
    def end(self) -> int:
        return int(self.voc.look_up(np.array([END], np.uint64))[0][0])

    def train(self, docs: list, rate: float, window: int = WINDOW, count: int = LANES) -> int:
        """One pass with Adam over the documents in pieces; the number of tokens."""
        pieces = [tuple(c[a:a + PIECE] for c in d) for d in docs for a in range(0, len(d[0]), PIECE)]
        s = Stream.of(pieces, count, self.end)
        params = self.w.arrays()
        m, u = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        h = np.zeros((s.x.shape[1], HIDDEN), np.float32)
        step = 0
        for lo in range(0, len(s.x), window):
            sl = slice(lo, lo + window)
            k = int(s.active[lo])
            h, grads = self.gradients(s, sl, k, h[:k])
            norm = math.sqrt(sum(float(np.vdot(g, g)) for g in grads))
            step += 1
            share, least = rate / (1 - 0.9 ** step) * math.sqrt(1 - 0.99 ** step), 1e-6 * math.sqrt(1 - 0.99 ** step)
            for i, (p, g) in enumerate(zip(params, grads, strict=True)):
                g *= np.float32(min(1.0, 1.0 / (norm + 1e-6)))
                m[i] *= np.float32(0.9)
                m[i] += np.float32(0.1) * g
                g *= g
                g *= np.float32(0.01)
                u[i] *= np.float32(0.99)
                u[i] += g
                np.sqrt(u[i], out=g)
                g += np.float32(least)
                np.divide(m[i], g, out=g)
                g *= np.float32(share)
                p -= g
        return int((s.doc >= 0).sum())

    def gradients(self, s: Stream, sl: slice, k: int, h: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The state after the window, and the gradients of its mean negative log-probability."""
        w, n = self.w, HIDDEN
        x, fresh, doc = s.x[sl, :k], s.fresh[sl, :k], s.doc[sl, :k].ravel()
        keep: list = []
        emb = np.take(w.embed.T.copy(), x, 1).reshape(w.embed.shape[1], -1)
        gates = w.wx.T @ emb
        gates += w.b[:, None]
        one = self.run(gates.reshape(-1, *x.shape), fresh, h.T, keep)
        last = one[:n, -1].T
        cls = s.cls[sl, :k].ravel()
        real = np.flatnonzero(doc >= 0)
        order, classes = self.by_class(cls[real])
        real = real[order]  # the tokens by class
        cls, place = cls[real], s.place[sl, :k].ravel()[real]
        own = np.take(one.reshape(n + 1, -1), real, 1)
        scale = np.float32(1 / len(real))
        d = _softmax(w.oc.T @ own)
        d[cls, np.arange(len(real))] -= 1
        d *= scale
        g_oc, g_one, g_ow = own @ d.T, w.oc @ d, np.zeros_like(w.ow)
        for _, rows, part in classes:
            d = _softmax(w.ow[:, part].T @ own[:, rows])
            d[place[rows], np.arange(d.shape[1])] -= 1
            d *= scale
            g_ow[:, part] = own[:, rows] @ d.T
            g_one[:, rows] += w.ow[:, part] @ d
        g_hs = np.zeros((n, x.size), g_one.dtype)
        g_hs[:, real] = g_one[:n]
        g_hs = g_hs.reshape(n, *x.shape)
        g_gates = np.empty((3 * n, *x.shape), np.float32)
        back = np.zeros((n, k), np.float32)
        w_ru, w_c = w.wh[:, :2 * n], w.wh[:, 2 * n:]
        befores, resets = np.empty((n, *x.shape), np.float32), np.empty((n, *x.shape), np.float32)
        begins, stay = fresh.any(1), (~fresh).astype(np.float32)
        for t in range(len(x) - 1, -1, -1):
            before, r, u, rh, c = keep[t]
            befores[:, t], resets[:, t] = before, rh
            g = g_hs[:, t] + back
            gu = g * u
            gc = (g - gu) * (1 - c * c)
            grh = w_c @ gc
            g_gates[:n, t] = grh * rh * (1 - r)
            g_gates[n:2 * n, t] = (before - c) * (gu * (1 - u))
            g_gates[2 * n:, t] = gc
            grh *= r
            back = w_ru @ g_gates[:2 * n, t]
            back += gu
            back += grh
            if begins[t]:
                back *= stay[t]
        flat = g_gates.reshape(3 * n, -1)
        g_wh = np.concatenate([befores.reshape(n, -1) @ flat[:2 * n].T, resets.reshape(n, -1) @ flat[2 * n:].T], 1)
        return last, [_summed(w.wx @ flat, x.ravel(), len(w.embed)), emb @ flat.T, g_wh, flat.sum(1), g_oc, g_ow]


# ---- on Spark

def cut_up(lens: np.ndarray, *columns: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Columns over all tokens as one tuple a document."""
    ends = np.cumsum(lens)
    return [tuple(c[a:b] for c in columns) for a, b in zip(ends - lens, ends, strict=True)]


def rare_terms(voc: Vocabulary, cls: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The log share of each token inside the last class; 0 for the others."""
    return np.where(cls == len(voc.members), np.log((counts + 0.1) / voc.rare), 0).astype(np.float32)


def prepared(voc: Vocabulary, hashes: list[np.ndarray], counts: np.ndarray | None = None) -> list:
    """The model's view of documents; counts: of all their tokens one after the other (not needed to train)."""
    x, c, p = voc.look_up(np.concatenate(hashes))
    static = np.zeros(len(x), np.float32) if counts is None else rare_terms(voc, c, counts)
    return cut_up(np.array([len(h) for h in hashes]), x, c, p, static)


def vocabulary(answers: DataFrame, words: int = WORDS) -> Vocabulary:
    """From the ranges' totals: two sums and the ``words`` most frequent tokens reach the driver."""
    r = answers.where("p is null").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for t, c in zip(f["top"], f["counts"], strict=True):
                yield pd.DataFrame({"h": np.frombuffer(t, "<i8"), "c": np.frombuffer(c, "<i8")})

    each = answers.where("p is null").select("top", "counts").mapInPandas(listed, "h long, c long")
    end = int(np.array([END]).view(np.int64)[0])
    top = [(x.h, x.c) for x in each.orderBy(F.desc("c"), "h").limit(words).collect()]
    top += [(x.h, x.c) for x in each.where(F.col("h") == end).collect() if x.h not in dict(top)]
    return Vocabulary.of(int(r[0]), int(r[1]), [(h % (1 << 64), c) for h, c in top], words)


def fitted(parts: DataFrame, voc: Vocabulary, fit_share: float = FIT_SHARE,
           rounds: int = ROUNDS, replica: int = REPLICA) -> Weights:
    """Rounds of local passes and averaging, each over documents of its own."""
    weights = Weights.start(voc)
    dealt = dealt_rounds(parts, voc, fit_share, rounds)
    sizes = {r["round"]: r["count"] for r in dealt.groupBy("round").count().collect()}
    schema = "k long, n long, w binary"
    for i in range(rounds):
        replicas = max(1, -(-sizes.get(i, 0) // replica))
        own = dealt.where(F.col("round") == i).withColumn("k", F.expr(f"pmod(h, {replicas})"))
        got = own.groupBy("k").applyInPandas(local_pass(voc, weights, 0.01 * (1 - i / rounds) + 0.001), schema)
        left = replicas
        while left > 1:
            left = -(-left // 16)
            got = got.withColumn("g", F.expr(f"pmod(k, {left})")).groupBy("g").applyInPandas(averaged, schema)
        for row in got.collect():  # one row, none without training documents
            weights = weights.unpack(bytes(row.w))
    return weights


def dealt_rounds(parts: DataFrame, voc: Vocabulary, fit_share: float = FIT_SHARE, rounds: int = ROUNDS) -> DataFrame:
    """h, round and model inputs of the documents to fit on: a threshold of their hash, no sort."""

    def chosen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for held, hs, lens, vals, numbers in zip(*(f[c] for c in f), strict=True):
                place = (np.array(hs, np.int64).view(np.uint64) >> np.uint64(11)) / float(1 << 53)  # in [0, 1)
                own = np.flatnonzero(~np.array(held, bool) & (place < fit_share))
                x = voc.inputs(unpack(vals))[unpack_numbers(numbers)]
                each = cut_up(np.array(lens, np.int64), x)
                yield pd.DataFrame({"h": [int(hs[i]) for i in own],
                                    "round": np.floor(place[own] / fit_share * rounds).astype(np.int64),
                                    "x": [pack_numbers(each[i][0]) for i in own]})

    rows = parts.select("held", "hs", "lens", "vals", "numbers").mapInPandas(chosen, "h long, round long, x binary")
    return staged(rows.dropDuplicates(["h"]), "lm-fit")


def lanes_for(tokens: int) -> int:
    """Lanes of one pass: as many as leave ``STEPS`` steps, within bounds."""
    return min(FIT_LANES, max(LANES, tokens // (STEPS * WINDOW)))


def local_pass(voc: Vocabulary, common: Weights, rate: float):
    """One replica's pass from the common weights."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        model = Model(voc, common.unpack(common.pack()))
        docs = [unpack_numbers(x) for x in frame.sort_values("h")["x"]]
        count = lanes_for(sum(len(x) for x in docs))
        n = model.train([(x, *voc.outputs(x), np.zeros(len(x), np.float32)) for x in docs], rate * (count / LANES) ** (1 / 3), count=count)
        return pd.DataFrame({"k": [key[0]], "n": [n], "w": [model.w.pack()]})

    return run


def averaged(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """The replicas' weights, each as heavy as its tokens."""
    f = frame.sort_values("k")
    n = f["n"].to_numpy(np.float64)
    mean = sum(np.frombuffer(w, "<f4") * (x / n.sum()) for w, x in zip(f["w"], n, strict=True))
    return pd.DataFrame({"k": [key[0]], "n": [int(n.sum())], "w": [mean.astype("<f4").tobytes()]})


def score_documents(docs: DataFrame, words: int = WORDS, fit_share: float = FIT_SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    parts = parted(docs)
    answers = staged(corpus_counts(parts, words), "lm-counts")
    voc = vocabulary(answers, words)
    model = Model(voc, fitted(parts, voc, fit_share))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scored(part: pa.Table, got: pa.Table) -> pa.Table:
        flat = {c: part[c].combine_chunks().flatten() for c in ("ids", "held", "lens")}
        lens = flat["lens"].to_numpy()
        numbers = unpack_numbers(part["numbers"][0].as_py())
        totals = np.concatenate([np.frombuffer(c, "<i8") for c in got.sort_by("r")["counts"].to_pylist()])
        x, cls, place = voc.look_up(unpack(part["vals"][0].as_py()))
        base = np.log10((totals + 0.1) / (voc.n + 0.1 * (voc.v + 1)))
        of = np.repeat(np.arange(len(lens)), lens)
        views = cut_up(lens, *(c[numbers] for c in (x, cls, place, rare_terms(voc, cls, totals))))
        return pa.table({
            "doc_id": flat["ids"], "held_out": flat["held"], "n_tokens": pa.array(lens, pa.int64()),
            "n_known": pa.array(np.bincount(of, (totals > 0)[numbers], len(lens)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(lens), voc.n, np.int64)),
            "base_score": pa.array(np.bincount(of, base[numbers], len(lens))), "score": pa.array(model.score(views))})

    back = answers.where("p is not null").select("p", "r", "counts")
    return parts.select("p", "ids", "held", "lens", "vals", "numbers").groupBy("p").cogroup(back.groupBy("p")).applyInArrow(
        scored, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
