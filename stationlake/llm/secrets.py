"""Secret scans: base patterns, and a character convolutional network over every candidate.

Base findings are those of three patterns (``assign``, ``access``, ``hex``).  A candidate has at least ``MIN_RUN``
characters (as a base value): what stands after ``:`` or ``=`` or between quotes, of any characters but white space and
quotes; every run of secret-like characters that is no plain word (letters of one case or capitalised, also joined by
``-``, ``.`` or ``/``); and every run of ASCII characters but quotes with a letter and a digit.  Candidates that overlap
are one.  Those that the base findings do not
cover whole are judged by the network and added as kind ``cnn``, whole; base findings always stay.

The network sees a candidate in tiles: ``CONTEXT`` characters before, up to ``VALUE`` characters of
the candidate, ``CONTEXT`` characters after (a longer candidate has several tiles, and its score is
the largest).  Convolutions over one-hot characters, one bank a zone, are pooled (maximum; for
the value also the mean) into a logistic output.

Training: labelled findings are all distinct tiles of the corpus' candidates (1: base findings cover the candidate whole, 0:
none touches it, it has no known secret shape and no word before it names a secret), and generated findings of common secret
and harmless shapes, of short values under telling and harmless names too.  In ``ROUNDS`` rounds, replicas of about ``REPLICA`` tiles each take one pass with Adam from the common weights over
their tiles and the generated ones, and their weights are averaged, so every tile is fitted on in every round.  The tiles of one label
together weigh ``fit_rows`` generated findings, however many they are (few positives one each, few harmless ones are repeated).  Half of the positives of ``BARE`` or
more characters lose their context, so that
the value's shape alone must do; a shorter value is a secret by its context.  One in four tiles (by a hash), all of them, calibrates
(Platt scaling) and sets the threshold: the largest logit at which at least ``RECALL`` of the held positives of
``BARE`` or more characters are found without their context, and as many of the shorter ones with it; those
whose value a base pattern matches by itself are left out.  Both are read from counts of the logits by steps of 1 / ``STEPS``.

Edge cases: a null text is the empty text, without findings; repeated rows give equal rows; an
empty table gives an empty result; a corpus without candidates is judged by the generated
findings alone; text lengths are not limited; other columns are not read (``redact`` keeps them).
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import forget, in_slices, staged

# The base patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "cnn")

MIN_RUN, BARE = 8, 16
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
PLAIN = re.compile(r"(?:[A-Za-z]?[a-z]*|[A-Z]*)(?:[-./]+(?:[A-Za-z]?[a-z]*|[A-Z]*))*")
NAMED = re.compile(r"""[:=]\x20?["'`]?([^\s"'`]{%d,})""" % MIN_RUN)
QUOTED = re.compile(r"""["'`]([^\s"'`]{%d,})(?=["'`])""" % MIN_RUN)
SOUP = re.compile(r"""[!#-&(-_a-~]{%d,}""" % MIN_RUN)
EDGES = ".,;:()<>#*|~"  # never a candidate's first or last characters
LETTER_DIGIT = re.compile(r"[A-Za-z][^0-9]*[0-9]|[0-9][^A-Za-z]*[A-Za-z]")
#: A name of a secret just before a value.
TELLING = re.compile(r"""(?:pw|pass|key|auth|secret|token|cred|bearer|login|pin)[A-Za-z_-]*["'`]?\x20*[:=]?\x20*["'`]?$""", re.I | re.A)
CONTEXT, VALUE, WIDTH, FILTERS = 24, 64, 5, 12
TILE = 2 * CONTEXT + VALUE
ZONES = ((0, CONTEXT), (CONTEXT, CONTEXT + VALUE), (CONTEXT + VALUE, TILE))
FIT_ROWS, GENERATED, GENERATED_VALUES = 2000, 2000, 4000
ROUNDS, REPLICA, HELD, STEPS = 8, 16_000, 4, 1024
RECALL = 0.97
#: Shapes that are never taken for harmless in training: issued keys, and mixed runs without structure.
SHAPES = re.compile(r"(?<![A-Za-z0-9])(?:gh[a-z]_|github_pat_|glpat-|sk-|[sr]k_(?:live|test)_|xox[a-z]-|AKIA|ASIA|AIza|ya29\.|eyJ|npm_|pypi-)|[0-9a-fA-F]{32}")
MIXED = re.compile(r"(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z])(?=[^0-9]*[0-9])[A-Za-z0-9+/_=-]{8,}", re.A)
MIXED_BITS = 3.5  # of a long value; a short one has at most the logarithm of its length

_CODE = {c: i + 1 for i, c in enumerate(string.ascii_letters + string.digits + string.punctuation)}
_CHAR = {i: c for c, i in _CODE.items()}
_SPACE, _OTHER = len(_CODE) + 1, len(_CODE) + 2
CODES = _OTHER + 1
_TABLE = str.maketrans({**{c: chr(i) for c, i in _CODE.items()}, **dict.fromkeys(" \t\n\r\v\f", chr(_SPACE))})

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The findings of the base patterns, by start, then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def candidates(text: str) -> list[tuple[int, int]]:
    """Disjoint candidates by start, without punctuation at their ends; access keys that are too short are none."""
    found = [m.span() for m in RUN.finditer(text) if not PLAIN.fullmatch(text, *m.span())]
    found += [m.span() for m in SOUP.finditer(text) if LETTER_DIGIT.search(text, *m.span())]
    named = [m.span(1) for pattern in (NAMED, QUOTED) for m in pattern.finditer(text)]
    found = sorted(found + named)
    out: list[tuple[int, int]] = []
    for a, b in found:
        while a < b and text[a] in EDGES:
            a += 1
        while a < b and text[b - 1] in EDGES:
            b -= 1
        if b - a < MIN_RUN or b - a < MIN_ACCESS and ACCESS.fullmatch(text, a, b):
            continue
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def covered(cands: list[tuple[int, int]], spans: list[Span]) -> list[bool | None]:
    """Whether base findings cover each candidate: whole, in part (null), or not (both by start; candidates are disjoint)."""
    out, merged = [], []
    for _, a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    i = 0
    for a, b in cands:
        while i < len(merged) and merged[i][1] <= a:
            i += 1
        if i == len(merged) or merged[i][0] >= b:
            out.append(False)
        else:
            out.append(True if merged[i][0] <= a and b <= merged[i][1] else None)
    return out


def doubtful(value: str) -> bool:
    """Whether a value looks like a secret: a known shape, or letters of both cases and digits of high entropy."""
    if SHAPES.search(value):
        return True
    if not MIXED.fullmatch(value):
        return False
    n = np.unique(list(value), return_counts=True)[1] / len(value)
    return float(-(n * np.log2(n)).sum()) >= min(MIXED_BITS, 0.85 * float(np.log2(len(value))))


def labels(text: str, cands: list[tuple[int, int]], spans: list[Span]) -> list[bool | None]:
    """For training: whether base findings cover each candidate; null, so judged only, where they cover a part
    of it, or none of it but it is doubtful or a telling name stands before it."""
    return [None if c is False and (doubtful(text[a:b]) or TELLING.search(text[max(0, a - CONTEXT):a])) else c
            for (a, b), c in zip(cands, covered(cands, spans), strict=True)]


def codes(part: str) -> bytes:
    return bytes(min(ord(c), _OTHER) for c in part.translate(_TABLE))


def tiles(text: str, a: int, b: int) -> list[bytes]:
    """The fixed-size views of one candidate; 0 fills what is missing."""
    out = []
    for lo in range(a, b, VALUE):
        hi = min(b, lo + VALUE)
        left, right = text[max(0, lo - CONTEXT):lo], text[hi:hi + CONTEXT]
        out.append(codes(left).rjust(CONTEXT, b"\0") + codes(text[lo:hi]).ljust(VALUE, b"\0")
                   + codes(right).ljust(CONTEXT, b"\0"))
    return out


def value_of(tile: bytes) -> str:
    """The candidate's characters in a tile."""
    return "".join(_CHAR.get(c, "\0") for c in tile[CONTEXT:CONTEXT + VALUE].rstrip(b"\0"))


@dataclass
class Network:
    """Banks (zone -> width x characters x filters), output weights, calibration and threshold."""

    banks: list[np.ndarray]
    out: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    @classmethod
    def start(cls, rng: np.random.Generator) -> Network:
        return cls([rng.normal(0, 0.1, (WIDTH, CODES, FILTERS)) for _ in ZONES], rng.normal(0, 0.1, 4 * FILTERS))

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """Features of the tiles, and what the gradient needs."""
        feats, kept = [], []
        for z, (lo, hi) in enumerate(ZONES):
            part = x[:, lo:hi]
            n = hi - lo - WIDTH + 1
            conv = sum(self.banks[z][o][part[:, o:o + n]] for o in range(WIDTH))
            conv = np.maximum(conv, 0)
            at = conv.argmax(1)
            feats.append(np.take_along_axis(conv, at[:, None, :], 1)[:, 0])
            if z == 1:
                count = np.maximum(1, (part[:, :n] > 0).sum(1))[:, None]
                feats.append((conv * (part[:, :n, None] > 0)).sum(1) / count)
            else:
                count = None
            kept.append((part, conv, at, count))
        return np.concatenate(feats, 1), kept

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.pooled(x[i:i + 512])[0] @ self.out + self.bias for i in range(0, len(x), 512)]
                              or [np.zeros(0)])

    def probabilities(self, parts: list[bytes]) -> np.ndarray:
        x = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, TILE)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(x) + self.shift, -30, 30)))

    def found(self, text: str, spans: list[Span]) -> list[Span]:
        """Candidates that the network adds to the base findings."""
        cands = candidates(text)
        return self.accepted([(a, b, tiles(text, a, b))
                              for (a, b), c in zip(cands, covered(cands, spans), strict=True) if not c])

    def accepted(self, cands: list[tuple[int, int, list[bytes]]]) -> list[Span]:
        if not cands:
            return []
        p = self.probabilities([t for _, _, ts in cands for t in ts])
        ends = np.cumsum([len(ts) for _, _, ts in cands])
        best = np.maximum.reduceat(p, np.concatenate([[0], ends[:-1]]))
        return [("cnn", a, b) for (a, b, _), q in zip(cands, best, strict=True) if q >= self.threshold]


def generated(n: int, seed: int = 3) -> list[tuple[bytes, int]]:
    """Labelled findings of common shapes, half of them harmless."""
    rng = np.random.default_rng(seed)
    pick = lambda alphabet, k: "".join(rng.choice(list(alphabet), k))
    num = lambda a, b: int(rng.integers(a, b))
    word = lambda: pick("etaoinshrdlu", num(3, 9))
    alnum = string.ascii_letters + string.digits
    secret = [lambda: "ghp_" + pick(alnum, 36), lambda: "sk-" + pick(alnum, 40), lambda: "AKIA" + pick("ABCDEFGHIJKLMNOP234567", 16),
              lambda: "xoxb-" + pick("0123456789", 11) + "-" + pick(alnum, 24), lambda: pick("0123456789abcdef", num(32, 65)),
              lambda: pick("0123456789ABCDEF", num(32, 65)), lambda: pick(alnum + "+/", num(32, 60)) + "=",
              lambda: "eyJ" + pick(alnum, 20) + "." + pick(alnum, 30) + "." + pick(alnum, 30),
              lambda: pick(alnum, num(20, 40))]
    harmless = [lambda: pick("0123456789", num(16, 20)), lambda: f"mail{num(1, 99)}.example.com", lambda: "/".join(word() for _ in range(5)) + f"/{num(1, 999)}",
                lambda: f"20{num(10, 30)}-{num(10, 13)}-{num(10, 29)}-{num(10, 24)}-{num(10, 60)}-00", lambda: ".".join(str(num(100, 256)) for _ in range(5)),
                lambda: "".join(word().title() for _ in range(4)) + str(num(1, 99)), lambda: "_".join(word() for _ in range(4)) + f"_{num(1, 99)}",
                lambda: "-" * num(14, 40) + str(num(1, 9)), lambda: "www." + word() + word() + f"{num(1, 99)}.example.org/en/{num(1, 999)}",
                lambda: "=" * num(8, 20) + str(num(1, 10 ** 8)) + "=" * num(8, 20), lambda: "-".join(str(num(10, 9999)) for _ in range(5)),
                lambda: "v" + ".".join(str(num(0, 30)) for _ in range(7)) + "-rc1", lambda: "+".join(word() + str(num(1, 9)) for _ in range(4))]
    lead = ["key: ", "password=", "token = \"", "secret: '", "Authorization: Bearer ", "", " ", "\n"]
    out = []
    for i in range(n):
        shapes = secret if i % 2 else harmless
        value = shapes[num(0, len(shapes))]()
        before = " ".join(word() for _ in range(5)) + " " + (lead[num(0, len(lead))] if i % 2 else " ")
        text = before + value + " " + " ".join(word() for _ in range(5))
        out += [(t, i % 2) for t in tiles(text, len(before), len(before) + len(value))]
    return out


def generated_values(n: int, seed: int = 4) -> list[tuple[bytes, int]]:
    """Labelled findings of values whose name tells: passwords and short keys, and harmless values under harmless names."""
    rng = np.random.default_rng(seed)
    pick = lambda alphabet, k: "".join(rng.choice(list(alphabet), k))
    num = lambda a, b: int(rng.integers(a, b))
    word = lambda: pick("etaoinshrdlubcmpgw", num(4, 10))
    one = lambda xs: xs[num(0, len(xs))]
    alnum = string.ascii_letters + string.digits
    secret = [lambda: pick(alnum, num(8, 16)), lambda: word() + pick(string.digits, num(1, 4)) + pick(string.ascii_lowercase, num(3, 6)),
              lambda: (word() + pick(string.digits, num(1, 4)) + pick("abcdefghimnstxyz", num(0, 4))).ljust(8, "1"),
              lambda: word().title() + pick("0134", 2) + pick("&!@#$%^*?", 1) + pick(alnum + "!&?", num(3, 12)),
              lambda: pick(alnum + "!&@#$%^*?+-", num(10, 24)), lambda: pick(string.ascii_letters, num(16, 30))]
    names = ["pwd", "client_key", "auth", "passphrase", "pass", "credential", "private_key", "access_key", "signing-key", "db_pw", "Auth", "PWD",
             "encryption key", "login_pass", "bearer", "user_pwd"]
    harmless = [lambda: pick("abcdefghijklmnoprstuvwz", num(8, 14)), lambda: word() + "_" + word() + "_" + word(), lambda: word() + word().title() + word().title(),
                lambda: pick(string.digits, num(8, 16)), lambda: f"20{num(10, 30)}-{num(10, 13)}-{num(10, 29)}", lambda: f"{word()}.{word()}@example.org",
                lambda: f"{word()}{num(1, 99)}.{one(['csv', 'html', 'jpeg', 'json'])}", lambda: f"{pick('ABCDEFGH', 3)}-{num(1000, 99999)}-{num(1, 9)}",
                lambda: f"//{word()}.example.com/{word()}/{num(1, 999)}", lambda: word() + word() + ",", lambda: word() + f"{num(10, 99)}" + word(),
                lambda: f"+{num(10, 99)}-{num(100, 999)}-{num(1000, 9999)}", lambda: pick("ABCDEFGHIJKLMNOPRSTUVW", num(5, 10)) + pick(string.digits, num(1, 4)),
                lambda: "AKIA" + pick("ABCDEFGHIJKLMNOPQRST", num(4, 8)) + pick(string.digits, 1),  # too short for a key
                lambda: ".".join(str(num(1, 256)) for _ in range(4)), lambda: f"{word()}.{num(1, 99)}@{word()}.example.org",
                lambda: pick("0123456789ABCDEF", num(8, 13)), lambda: f"{num(10, 99)}/{num(10, 99)}/{num(1900, 2030)}", lambda: word() + "-" + word() + f"-{num(1, 99)}"]
    calm = ["note", "title", "name", "https", "id", "total", "source", "section", "see", "phone", "email", "user", "date", "item", "lang", "path"]
    out = []
    for i in range(n):
        value = one(secret if i % 2 else harmless)()
        if i % 2:
            before = one(names) + one([": ", "=", " = ", ": \"", " = \"", "='"])
        else:
            before = one([one(calm) + one([": ", "=", " = ", ":", " = \""]), "\"", "'", " ", " ", ""])
        text = " ".join(word() for _ in range(4)) + one([" ", "\n"]) + before
        out += [(t, i % 2) for t in tiles(text + value + one([" ", "\n", "\" ", "."]) + word(), len(text), len(text) + len(value))]
    return out


def fit(rows: list[tuple[bytes, int]], epochs: int = 8, seed: int = 5, rate: float = 0.01, batch: int = 64,
        recall: float = RECALL) -> Network:
    """Adam on three of four rows, then calibration and threshold on the fourth."""
    rng = np.random.default_rng(seed)
    net = Network.start(rng)
    x = np.frombuffer(b"".join(t for t, _ in rows), np.uint8).reshape(-1, TILE)
    y = np.array([v for _, v in rows], np.float64)
    order = rng.permutation(len(x))
    held, own = order[:len(x) // 4], order[len(x) // 4:]
    x = blanked(x.copy(), y, own, rng)
    adam = Adam.of(net)
    for epoch in range(epochs):
        own = rng.permutation(own)
        adam.run(x, y, np.ones(len(x)), own, rate * (1 - epoch / epochs) + 1e-4, batch)
    calibrate(net, net.logits(x[held]), y[held], np.ones(len(held)))
    net.threshold = recalled(net, [rows[i][0] for i in held if rows[i][1]], recall)
    return net


def blanked(x: np.ndarray, y: np.ndarray, own: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Half of the long positives, which must be told by the value alone, and of the harmless tiles lose their context."""
    long = (x[:, CONTEXT:CONTEXT + VALUE] > 0).sum(1) >= BARE
    bare = own[(y[own] == 1) & long[own] & (rng.random(len(own)) < 0.5)]
    x[bare, :CONTEXT] = 0
    x[bare, CONTEXT + VALUE:] = 0
    blank = own[(y[own] == 0) & (rng.random(len(own)) < 0.5)]
    x[blank, :CONTEXT] = 0
    x[blank, CONTEXT + VALUE:] = 0
    return x


@dataclass
class Adam:
    net: Network
    params: list[np.ndarray]
    m: list[np.ndarray]
    u: list[np.ndarray]
    step: int = 0

    @classmethod
    def of(cls, net: Network) -> Adam:
        params = [*net.banks, net.out, np.array([net.bias])]
        return cls(net, params, [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params])

    def run(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, own: np.ndarray, lr: float, batch: int) -> None:
        """One pass over the tiles ``own`` in their order."""
        net, params, m, u = self.net, self.params, self.m, self.u
        for at in range(0, len(own), batch):
            r = own[at:at + batch]
            feats, kept = net.pooled(x[r])
            z = feats @ net.out + params[-1][0]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[r]) * (weight[r] / weight[r].sum())
            df = g[:, None] * net.out[None, :]
            grads, k = [], 0
            for zone, (part, conv, arg, count) in enumerate(kept):
                n = conv.shape[1]
                d = np.zeros_like(conv)
                np.put_along_axis(d, arg[:, None, :], df[:, None, k:k + FILTERS], 1)
                k += FILTERS
                if zone == 1:
                    d += (df[:, None, k:k + FILTERS] / count[:, :, None]) * (part[:, :n, None] > 0)
                    k += FILTERS
                d *= conv > 0
                flat = d.reshape(-1, FILTERS)
                grads.append(np.stack([
                    np.stack([np.bincount(part[:, o:o + n].ravel(), flat[:, f], CODES) for f in range(FILTERS)], 1)
                    for o in range(WIDTH)]))
            grads += [feats.T @ g + 1e-4 * net.out, np.array([g.sum()])]
            self.step += 1
            for i, (p, gr) in enumerate(zip(params, grads, strict=True)):
                m[i] = 0.9 * m[i] + 0.1 * gr
                u[i] = 0.999 * u[i] + 0.001 * gr * gr
                p -= lr * (m[i] / (1 - 0.9 ** self.step)) / (np.sqrt(u[i] / (1 - 0.999 ** self.step)) + 1e-8)
        net.bias = float(params[-1][0])


def calibrate(net: Network, z: np.ndarray, t: np.ndarray, weight: np.ndarray) -> None:
    """Platt scaling on logits with labels and weights."""
    net.slope, net.shift = 1.0, 0.0
    yes, no = (weight * t).sum(), (weight * (1 - t)).sum()
    target = np.where(t == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -30, 30)))
        w, r = weight * (p * (1 - p) + 1e-9), weight * (p - target)
        h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        d = np.clip(np.linalg.solve(h, np.array([(r * z).sum(), r.sum()])), -1, 1)
        net.slope, net.shift = max(1e-3, net.slope - float(d[0])), net.shift - float(d[1])
        if abs(d).max() < 1e-7:
            break


def recalled(net: Network, positives: list[bytes], recall: float) -> float:
    """The threshold that finds the asked share of the positives of ``BARE`` or more characters by their values alone, and of
    the shorter ones; those that a base pattern matches without any context are left out (unless there are no others)."""
    own = [t for t in positives if not base_spans(value_of(t))] or positives
    long = [bytes(CONTEXT) + t[CONTEXT:CONTEXT + VALUE] + bytes(CONTEXT) for t in own if t[CONTEXT + BARE - 1]]
    short = [t for t in own if not t[CONTEXT + BARE - 1]]
    return min(threshold(net.probabilities(g), np.ones(len(g)), recall) for g in (long, short))


def threshold(p: np.ndarray, y: np.ndarray, recall: float, precision: float = 0.0) -> float:
    """The largest p with the asked recall; raised while the precision there is under its floor (none as used here)."""
    pos = np.sort(p[y == 1])[::-1]
    if not len(pos):
        return 1.0
    at = float(pos[max(0, int(np.ceil(recall * len(pos))) - 1)])
    for t in [at, *np.unique(pos[pos > at])]:
        if (y[p >= t] == 1).mean() >= precision:
            return float(t)
    return float(pos[0])


SCAN = ("n_assign long, n_access long, n_hex long, base string, starts array<long>, ends array<long>, "
        "known array<boolean>, tiles array<array<binary>>")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base findings and all candidates with their tiles, in one pass over the whole texts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in in_slices(batches):
            cols: list[list] = [[] for _ in range(8)]
            for text in b.column(1).to_pylist():
                text = text or ""
                spans = base_spans(text)
                cands = candidates(text)
                kinds = [k for k, _, _ in spans]
                row = (*(kinds.count(k) for k in KINDS[:3]), joined(spans), [c[0] for c in cands], [c[1] for c in cands],
                       labels(text, cands, spans), [tiles(text, *c) for c in cands])
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            types = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()),
                                        pa.list_(pa.list_(pa.binary()))]
            names = ["n_assign", "n_access", "n_hex", "base", "starts", "ends", "known", "tiles"]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                                             names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(scanned, f"doc_id {id_type}, {SCAN}")


def labelled(scanned: DataFrame) -> DataFrame:
    """Every distinct labelled tile of the corpus: known, tile, h (a hash), held (calibrates instead of fitting)."""
    return (scanned.where("size(starts) > 0").select(F.explode(F.arrays_zip("known", "tiles")).alias("c"))
            .select(F.col("c.known").alias("known"), F.explode("c.tiles").alias("tile")).where("known is not null").distinct()
            .withColumn("h", F.xxhash64("tile")).withColumn("held", F.expr(f"pmod(h, {HELD}) = 0")))


def weights(y: np.ndarray, fit_rows: float) -> np.ndarray:
    """Weights of tiles with these labels: a label's weigh ``fit_rows`` together, a tile at most 1."""
    n = np.bincount(y.astype(np.int64), minlength=2)
    return np.minimum(1.0, fit_rows / np.maximum(n, 1))[y.astype(np.int64)]


def train(scanned: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS, replica: int = REPLICA, rate: float = 0.01) -> Network:
    """Fit on every labelled tile of the corpus (either label weighs ``fit_rows`` generated findings) and on generated findings."""
    spark = scanned.sparkSession
    each = staged(labelled(scanned), "secret-tiles")
    made = generated(GENERATED) + generated_values(GENERATED_VALUES)
    net = Network.start(np.random.default_rng(5))
    put = np.random.default_rng(7).permutation(len(made))
    own, kept_back = [made[i] for i in put[len(made) // HELD:]], [made[i] for i in put[:len(made) // HELD]]
    replicas = max(1, -(-each.where("not held").count() // replica))
    # a row without a tile, so that every replica is there
    marks = spark.range(replicas).selectExpr("id AS k", "cast(null AS binary) AS tile", "false AS known")
    rows = each.where("not held").selectExpr(f"pmod(shiftright(h, 8), {replicas}) AS k", "tile", "known").unionByName(marks)
    for i in range(rounds):
        got = rows.groupBy("k").applyInPandas(local_pass(net, own, 0.75 * fit_rows, rate * (1 - i / rounds) + 1e-4, i), "k long, w binary, n long")
        left = replicas
        while left > 1:
            left = -(-left // 16)
            got = got.withColumn("g", F.expr(f"pmod(k, {left})")).groupBy("g").applyInPandas(averaged, "k long, w binary, n long")
        net = unpacked(net, bytes(got.first()["w"]))
    return settled(net, each.where("held"), kept_back, fit_rows / HELD)


def packed(net: Network) -> bytes:
    return np.concatenate([*(b.ravel() for b in net.banks), net.out, [net.bias]]).astype("<f8").tobytes()


def unpacked(like: Network, raw: bytes) -> Network:
    flat, at, banks = np.frombuffer(raw, "<f8"), 0, []
    for b in like.banks:
        banks.append(flat[at:at + b.size].reshape(b.shape).copy())
        at += b.size
    return Network(banks, flat[at:-1].copy(), float(flat[-1]))


def local_pass(common: Network, made: list[tuple[bytes, int]], fit_rows: float, rate: float, number: int, batch: int = 32):
    """One replica's pass from the common weights over its tiles and the generated ones."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        net = unpacked(common, packed(common))
        frame = frame[frame["tile"].notna()].sort_values(["tile", "known"])
        harmless = frame["known"].to_numpy(bool) == 0
        again = np.where(harmless, max(1, int(fit_rows) // max(1, int(harmless.sum()))), 1)  # few harmless ones count as many
        frame = frame.loc[frame.index.repeat(again)]
        x = np.frombuffer(b"".join([*frame["tile"], *(t for t, _ in made)]), np.uint8).reshape(-1, TILE)
        y = np.concatenate([frame["known"].to_numpy(np.float64), np.array([v for _, v in made], np.float64)])
        w = np.concatenate([weights(y[:len(frame)], fit_rows), np.ones(len(made))])
        rng = np.random.default_rng([int(key[0]), number])
        x = blanked(x.copy(), y, np.arange(len(x)), rng)
        Adam.of(net).run(x, y, w, rng.permutation(len(x)), rate, batch)
        return pd.DataFrame({"k": [key[0]], "w": [packed(net)], "n": [len(x)]})

    return run


def averaged(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """The replicas' weights, each as heavy as its tiles."""
    f = frame.sort_values("k")
    n = f["n"].to_numpy(np.float64)
    mean = sum(np.frombuffer(w, "<f8") * (x / n.sum()) for w, x in zip(f["w"], n, strict=True))
    return pd.DataFrame({"k": [key[0]], "w": [mean.tobytes()], "n": [int(n.sum())]})


def logit_steps(net: Network, tiles_: list[bytes], y: list[bool]) -> pd.DataFrame:
    """How many tiles have their logit in which step: by label, and of the positives that set the threshold the long ones
    (their values alone) and the short ones."""
    x = np.frombuffer(b"".join(tiles_), np.uint8).reshape(-1, TILE)
    z, y = net.logits(x), np.array(y, bool)
    asked = np.array([bool(v) and not base_spans(value_of(t)) for t, v in zip(tiles_, y, strict=True)], bool)
    long = x[:, CONTEXT + BARE - 1] > 0
    bare = x[asked & long].copy()
    bare[:, :CONTEXT] = 0
    bare[:, CONTEXT + VALUE:] = 0
    parts = {"no": z[~y], "yes": z[y], "long": net.logits(bare), "short": z[asked & ~long]}
    out = [pd.DataFrame({"part": name, "step": np.floor(np.clip(v, -1000, 1000) * STEPS).astype(np.int64)}) for name, v in parts.items()]
    return pd.concat(out).groupby(["part", "step"]).size().rename("n").reset_index()


def settled(net: Network, held: DataFrame, made: list[tuple[bytes, int]], fit_rows: float, recall: float = RECALL) -> Network:
    """Calibration and threshold from all held tiles; those of the corpus weigh ``fit_rows`` by label."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield logit_steps(net, list(f["tile"]), list(f["known"]))

    got = (held.select("tile", "known").mapInPandas(counted, "part string, step long, n long").groupBy("part", "step")
           .agg(F.sum("n").alias("n")).toPandas())
    own = logit_steps(net, [t for t, _ in made], [v for _, v in made])
    n = {k: int(v) for k, v in got.groupby("part")["n"].sum().items()}
    each = {"no": fit_rows / max(n.get("no", 0), 1), **dict.fromkeys(("yes", "long", "short"), min(1.0, fit_rows / max(n.get("yes", 0), 1)))}
    got["w"] = got["n"] * got["part"].map(each).astype(float)
    rows = pd.concat([got, own.assign(w=own["n"].astype(float))])
    both = rows[rows["part"].isin(["no", "yes"])]
    calibrate(net, (both["step"].to_numpy() + 0.5) / STEPS, (both["part"] == "yes").to_numpy(np.float64), both["w"].to_numpy())
    least = []
    for part in ("long", "short"):
        f = rows[rows["part"] == part].sort_values("step", ascending=False)
        if len(f):
            at = int(np.argmax(f["w"].cumsum().to_numpy() >= recall * f["w"].sum() - 1e-9))
            least.append(f["step"].iloc[at] / STEPS)  # the step's lower end, so that all of it is found
    net.threshold = 1 / (1 + np.exp(-np.clip(net.slope * min(least) + net.shift, -30, 30)))
    return net


def find_secrets(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, n_cnn, spans of every document."""
    found = staged(scan(docs), "secret-scan")
    net = train(found, fit_rows)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "n_cnn", "spans"]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, added, spans = [], [], []
            for base, starts, ends, known, ts in zip(*(b.column(k).to_pylist() for k in range(4, 9)), strict=True):
                own = [(k, int(a), int(e)) for k, a, e in (s.split(":") for s in base.split(",") if s)]
                new = net.accepted([(a, e, t) for a, e, k, t in zip(starts, ends, known, ts, strict=True) if not k])
                digests.append(sha256(base.encode()).hexdigest())
                added.append(len(new))
                spans.append(joined(ordered(own + new)))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(4)), pa.array(digests, pa.string()),
                                              pa.array(added, pa.int64()), pa.array(spans, pa.string())], names=names)

    return found.mapInArrow(judged, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                    "n_cnn long, spans string")


def blank_out(text: str | None, net: Network, mark: str = "[SECRET]") -> str | None:
    """The text with every finding (overlapping ones as one) replaced by ``mark``."""
    if not text:
        return text
    base = base_spans(text)
    out, at = [], 0
    for _, a, b in ordered(base + net.found(text, base)):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]]) if at else text


def redact(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """All columns of the documents, the findings in ``text`` replaced and ``n_chars`` set anew where one was."""
    net = train(staged(scan(docs), "secret-scan"), fit_rows)
    names = docs.columns

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in in_slices(batches):
            cols = dict(zip(names, b.columns, strict=True))
            old = cols["text"].to_pylist()
            new = [blank_out(t, net) for t in old]
            if "n_chars" in cols:
                n = cols["n_chars"]
                cols["n_chars"] = pa.array([len(t) if t != o else c for t, o, c in zip(new, old, n.to_pylist(), strict=True)],
                                           n.type)
            cols["text"] = pa.array(new, cols["text"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return docs.mapInArrow(cleaned, docs.schema)
