"""BPE encoding and decoding by a tokenization automaton compiled from the merges.

The automaton reads tokens as arc labels: a state says which token was read last, and its arcs
say which tokens may follow.  At first only base symbols have arcs, between all states.  Then
one gadget a merge, in rank order: merging (u, v) to w takes the arc v from the state of u (the
two would have been merged), and gives w an arc wherever u had one, leading to a copy of the
state of v.  A state is kept as its difference from the state it was copied from, so one gadget
is one entry: ``left`` and ``right`` of w, and the rank at which arc v left the state of u.
Whether an arc exists is then read off by following the copies back (``Automaton.arc``).

A text's only accepted path is its BPE tokenization.  To find it in one pass over the bytes, the
automaton is determinised step by step: a machine state is the trie node of the longest suffix
that may still grow into a token, with the last arc of every position that such a token can
start from.  Transitions are computed once and then looked up in a table; the table has a bound
and starts anew beyond it.  The arcs are read back from the end of the word; decoding emits the
labels of the arcs.

Words are pre-split as the tokenizer file says (NFC, lower case, pattern); white space is
dropped, so ASCII white space cuts a text into chunks that are encoded independently and
remembered within a bounded table.

Edge cases: a null text is the empty text: no ids, empty decoded text; a text's length is
not limited; repeated rows give equal rows; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stationlake.llm.common import Remembered, in_slices, kept

#: Bounds of a worker's tables: machine states, and chunks seen of late.  They set memory and time, never results.
MAX_STATES = 100_000
MAX_CHUNKS = 100_000


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class Automaton:
    """Compiled from base symbols (byte, ends its word) and merges (u, v, w) of token numbers."""

    def __init__(self, symbols: dict[int, tuple[int, bool]], merges: list[tuple[int, int, int]],
                 max_states: int = MAX_STATES) -> None:
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = dict.fromkeys(symbols, -1)
        self.gone: dict[tuple[int, int], int] = {}
        self.bytes: dict[int, bytes] = {t: bytes([b]) for t, (b, _) in symbols.items()}
        self.ends: dict[int, bool] = {t: e for t, (_, e) in symbols.items()}
        for rank, (u, v, w) in enumerate(merges):
            if w in self.born or u not in self.born or v not in self.born or self.ends[u]:
                raise ValueError(f"merge {rank} is not proper")
            self.gadget(rank, u, v, w)
        self.arcs: dict[tuple[int, int], bool] = {}
        self.max_states = max_states
        self._trie()
        self._reset()

    def gadget(self, rank: int, u: int, v: int, w: int) -> None:
        self.gone[u, v] = rank
        self.left[w], self.right[w], self.born[w] = u, v, rank
        self.bytes[w], self.ends[w] = self.bytes[u] + self.bytes[v], self.ends[v]

    def arc(self, t: int, x: int) -> bool:
        """Whether x may follow t.

        The younger of the two got its state or arc as a copy when it was born, so the answer is
        what it was then for the token it was copied from; an arc that left earlier is gone.  Of
        two equal merges in overlap the left one wins, so a copy of x counts its own rank too.
        """
        known = self.arcs.get((t, x))
        if known is not None:
            return known
        a, b, before = t, x, len(self.born) + 1
        while True:
            if self.gone.get((a, b), before) < before:
                out = False
                break
            if self.born[a] < 0 and self.born[b] < 0:
                out = True
                break
            if self.born[a] > self.born[b]:
                before, a = self.born[a], self.right[a]
            else:
                before, b = self.born[b] + 1, self.left[b]
        if len(self.arcs) >= 2 * self.max_states:
            self.arcs.clear()
        self.arcs[t, x] = out
        return out

    def _trie(self) -> None:
        """Trie of all labels with suffix links; a node's chain lists the tokens that end there."""
        child: list[dict[int, int]] = [{}]
        plain, end, depth = [-1], [-1], [0]
        for t, label in self.bytes.items():
            at = 0
            for b in label:
                nxt = child[at].get(b)
                if nxt is None:
                    nxt = child[at][b] = len(child)
                    child.append({})
                    plain.append(-1)
                    end.append(-1)
                    depth.append(depth[at] + 1)
                at = nxt
            (end if self.ends[t] else plain)[at] = t
        fail = [0] * len(child)
        tokens: list[tuple[int, ...]] = [()] * len(child)
        ending: list[tuple[int, ...]] = [()] * len(child)
        todo = deque(child[0].values())
        for n in child[0].values():
            tokens[n] = (plain[n],) if plain[n] >= 0 else ()
            ending[n] = (end[n],) if end[n] >= 0 else ()
        while todo:
            n = todo.popleft()
            for b, m in child[n].items():
                f = fail[n]
                while f and b not in child[f]:
                    f = fail[f]
                fail[m] = child[f].get(b, 0)
                tokens[m] = ((plain[m],) if plain[m] >= 0 else ()) + tokens[fail[m]]
                ending[m] = ((end[m],) if end[m] >= 0 else ()) + ending[fail[m]]
                todo.append(m)
        self.child, self.fail, self.depth, self.tokens, self.ending = child, fail, depth, tokens, ending
        self.size = {t: len(x) for t, x in self.bytes.items()}

    def _reset(self) -> None:
        """Only the start: nothing read, no last arc."""
        self.start = _State(self, 0, (-1,))
        self.states: dict[tuple, _State] = {(0, (-1,)): self.start}

    def _node(self, node: int, byte: int) -> int:
        while node and byte not in self.child[node]:
            node = self.fail[node]
        return self.child[node].get(byte, 0)

    def _last(self, lasts: tuple[int, ...], tokens: tuple[int, ...]) -> int:
        """The one token among those ending here that the state before it has an arc for."""
        for t in tokens:
            k = len(self.bytes[t]) - 1
            if k < len(lasts) and (lasts[k] < 0 or self.arc(lasts[k], t)):
                return t
        raise ValueError("a byte without a symbol")

    def step(self, s: _State, byte: int) -> _State:
        after = self._node(s.node, byte)
        key = (after, (self._last(s.lasts, self.tokens[after]), *s.lasts[:self.depth[after]]))
        new = self.states.get(key)
        if new is None:
            new = self.states[key] = _State(self, *key)
        return new

    def finish(self, s: _State, byte: int) -> int:
        t = s.final[byte] = self._last(s.lasts, self.ending[self._node(s.node, byte)])
        return t

    def encode(self, word: bytes) -> list[int]:
        """The token numbers of one pre-split word whose last symbol carries the end of word."""
        if not word:
            return []
        if len(self.states) > self.max_states:
            self._reset()
        s = self.start
        path = [s]
        end = word[-1]
        for b in word[:-1]:
            s = s[b]
            path.append(s)
        t = s.final.get(end)
        if t is None:
            t = self.finish(s, end)
        size = self.size
        out, at = [t], len(word) - size[t]
        while at > 0:
            t = path[at].last
            out.append(t)
            at -= size[t]
        out.reverse()
        return out


class _State(dict):
    """A machine state: the table of its transitions by byte, filled as they are first taken."""

    __slots__ = ("machine", "node", "lasts", "last", "final")

    def __init__(self, machine: Automaton, node: int, lasts: tuple[int, ...]) -> None:
        self.machine, self.node, self.lasts, self.last, self.final = machine, node, lasts, lasts[0], {}

    def __missing__(self, byte: int) -> _State:
        new = self[byte] = self.machine.step(self, byte)
        return new


class WordTokenizer:
    """The tokenizer of a file with a word-end suffix, on the automaton."""

    def __init__(self, path: str, max_states: int = MAX_STATES, max_chunks: int = MAX_CHUNKS) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or not suffix or model["unk_token"]:
            raise ValueError("the file asks for steps that are not built")
        letters = byte_letters()
        symbols = {vocab[c + e]: (b, bool(e)) for b, c in enumerate(letters) for e in ("", suffix)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.automaton = Automaton(symbols, [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs], max_states)
        self.labels: dict[int, str] = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels |= {i: t for t, i in self.special.items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.chunks = Remembered(self.pieces, max_chunks)

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a text without ASCII white space (or any whole text)."""
        out: list[int] = []
        for part in self.cut.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(self.special[part])
                continue
            if part.isascii():
                part = part.lower()
            else:  # letter by letter: the one rule that looks at neighbours, of the capital sigma, is not asked for
                part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
            for w in self.pattern.findall(part):
                out += self.automaton.encode(w.encode("utf-8"))
        return out

    def encode(self, text: str | None) -> list[int]:
        return [i for c in (text or "").encode().split() for i in self.encode_chunk(c.decode())]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.labels[i] for i in ids])

    def pieces(self, chunk: bytes) -> tuple[bytes, bytes]:
        """The ids (little-endian, 32 bits) and the labels of a chunk."""
        ids = self.encode_chunk(chunk.decode())
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids).encode()

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids, sha256 of the decoded text; built up in parts of bounded size."""
        chunks = (text or "").encode().split()
        n, ids, decoded, first = 0, sha256(), sha256(), True
        for at in range(0, len(chunks), 4096):
            got = list(map(self.chunks.__getitem__, chunks[at:at + 4096]))
            packed = b"".join([i for i, _ in got])
            labels = b" ".join([t for _, t in got if t])
            n += len(packed) // 4
            ids.update(packed)
            if labels:
                decoded.update(labels if first else b" " + labels)
                first = False
        return n, ids.hexdigest(), decoded.hexdigest()


def load(path: str, max_states: int = MAX_STATES, max_chunks: int = MAX_CHUNKS) -> WordTokenizer:
    """The compiled automaton and its tables, kept by a worker process."""
    return kept(f"automaton {path} {max_states} {max_chunks}", lambda: WordTokenizer(path, max_states, max_chunks))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, max_states: int = MAX_STATES,
                     max_chunks: int = MAX_CHUNKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    path = path or default_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path, max_states, max_chunks)
        for b in in_slices(batches):
            out = [tok.digest(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string()),
                 pa.array([o[2] for o in out], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        encoded, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
