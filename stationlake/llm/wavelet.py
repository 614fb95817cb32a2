"""Token ids in succinct files: one wavelet matrix a shard.

A shard file holds the ids of consecutive documents (ascending doc_id) as a wavelet matrix:
one bit-plane a bit of the largest number, highest bit first; on each plane the ids with bit 0 keep
their order and come first on the next plane, then those with bit 1.  The ids are first numbered within the
shard (its alphabet, ascending), which saves planes.  Each plane has a rank
directory (ones before every ``BLOCK`` bits), so ``access``, ``rank`` (count of a token in a
range) and ``select`` (its k-th occurrence) read a few blocks a plane.  Blocks are compressed
one by one (zstd, or stored as they are if that is no smaller) behind a table of offsets, so a
query decompresses only what it reads.

Layout (little-endian): magic ``WMX1``, uint32 docs, uint64 tokens, uint32 planes, uint32 bits a
block, uint32 size of the alphabet, uint32 size of the zstd-compressed table (of documents int64 ids,
uint8 null flags, uint32 tokens; then the alphabet, uint32); then for every plane uint64 zeros, uint32 ones before each block (and in all), uint64
end of each block in the data (highest bit of the end set: stored as it is); then the data.

Writing: documents are ranged by doc_id, sorted inside the range, and each task cuts its
documents into shards of about ``SHARD_TOKENS`` tokens, so a task holds one shard at a time.  A
file is written under a temporary name in the shared folder and then moved, so a repeated task
replaces it by the same bytes.  Starts are sums over ranges, then over the shards of a range.

Edge cases: a null or empty text has the end id only; a null doc_id comes first; equal ids are
ordered by text; an empty table gives no file and an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.llm.bpe_automaton import byte_letters
from stationlake.llm.common import Remembered, forget, in_slices, kept, new_path, staged

END_ID = 2
BLOCK = 1 << 15
SHARD_TOKENS = 1 << 20
FILES_A_TASK = 8
MAX_PIECES = 800_000
_STORED = np.uint64(1 << 63)
_HEAD = "<4sIQIIII"


# ---- the file format

def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], block: int = BLOCK) -> bytes:
    """The file of one shard."""
    n = len(ids)
    if n and ids.max() < 1 << 22:
        seen = np.bincount(ids) > 0
        alphabet, numbers = np.flatnonzero(seen).astype("<u4"), (np.cumsum(seen, dtype=np.uint32) - np.uint32(1))[ids]
    else:  # no table over so wide a range of ids
        alphabet, numbers = np.unique(np.asarray(ids, "<u4"), return_inverse=True)
    planes = max(1, (len(alphabet) - 1).bit_length())
    level = numbers.astype(np.uint16 if planes <= 16 else np.uint32)
    press = zstandard.ZstdCompressor(level=1)
    table = press.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes()
                           + np.array([d is None for d in doc_ids], np.uint8).tobytes()
                           + np.array(lengths, "<u4").tobytes() + alphabet.tobytes())
    heads, data, at = [], [], 0
    for p in range(planes - 1, -1, -1):
        bits = (level & level.dtype.type(1 << p)) != 0
        ones, ends = [0], []
        for lo in range(0, n, block):
            part = bits[lo:lo + block]
            raw = np.packbits(part).tobytes()
            small = press.compress(raw)
            stored = len(small) >= len(raw)
            data.append(raw if stored else small)
            at += len(data[-1])
            ends.append(at | (int(_STORED) if stored else 0))
            ones.append(ones[-1] + int(np.count_nonzero(part)))
        heads.append(struct.pack("<Q", n - ones[-1]) + np.array(ones, "<u4").tobytes() + np.array(ends, "<u8").tobytes())
        level = np.concatenate([level.take(np.flatnonzero(~bits)), level.take(np.flatnonzero(bits))])
    return b"".join([struct.pack(_HEAD, b"WMX1", len(doc_ids), n, planes, block, len(alphabet), len(table)), table, *heads, *data])


class WaveletFile:
    """Token access, counting and occurrence lookup in the bytes of one shard file."""

    def __init__(self, raw: bytes) -> None:
        magic, self.n_docs, self.n, self.planes, self.block, letters, size = struct.unpack_from(_HEAD, raw)
        if magic != b"WMX1":
            raise ValueError("not a shard file")
        self.raw, at = raw, struct.calcsize(_HEAD)
        self._press = zstandard.ZstdDecompressor()
        table, d = self._press.decompress(raw[at:at + size]), self.n_docs
        at += size
        null = np.frombuffer(table, np.uint8, d, 8 * d)
        self.doc_ids = [None if z else int(i) for i, z in zip(np.frombuffer(table, "<i8", d), null, strict=True)]
        self.lengths = np.frombuffer(table, "<u4", d, 9 * d).astype(np.int64)
        self.alphabet = np.frombuffer(table, "<u4", letters, 13 * d)
        k = -(-self.n // self.block)
        self.zeros, self.ones, self.ends = [], [], []
        for _ in range(self.planes):
            self.zeros.append(struct.unpack_from("<Q", raw, at)[0])
            self.ones.append(np.frombuffer(raw, "<u4", k + 1, at + 8).astype(np.int64))
            self.ends.append(np.frombuffer(raw, "<u8", k, at + 8 + 4 * (k + 1)))
            at += 8 + 4 * (k + 1) + 8 * k
        self.data = at
        self._bits = lru_cache(maxsize=64)(self._read_block)

    def _read_block(self, plane: int, k: int) -> np.ndarray:
        ends = self.ends[plane]
        before = ends[k - 1] if k else (self.ends[plane - 1][-1] if plane and len(ends) else np.uint64(0))
        lo, hi = self.data + int(before & ~_STORED), self.data + int(ends[k] & ~_STORED)
        part = self.raw[lo:hi] if ends[k] & _STORED else self._press.decompress(self.raw[lo:hi])
        return np.unpackbits(np.frombuffer(part, np.uint8), count=min(self.block, self.n - k * self.block))

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        k, r = divmod(i, self.block)
        return int(self.ones[plane][k]) + (int(np.count_nonzero(self._bits(plane, k)[:r])) if r else 0)

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for p in range(self.planes):
            bit = int(self._bits(p, i // self.block)[i % self.block])
            r = self._rank1(p, i)
            i = self.zeros[p] + r if bit else i - r
            token = token << 1 | bit
        return int(self.alphabet[token])

    def _number(self, token: int) -> int:
        """A token's number in the alphabet, -1 without."""
        k = int(np.searchsorted(self.alphabet, token)) if token >= 0 else len(self.alphabet)
        return k if k < len(self.alphabet) and self.alphabet[k] == token else -1

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of a token's number in [lo, hi) lie below the last plane."""
        if token < 0:
            return 0, 0
        for p in range(self.planes):
            a, b = self._rank1(p, lo), self._rank1(p, hi)
            if token >> (self.planes - 1 - p) & 1:
                lo, hi = self.zeros[p] + a, self.zeros[p] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in positions [lo, hi)."""
        a, b = self._range(self._number(token), lo, self.n if hi is None else hi)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of a token; IndexError if there are fewer."""
        token = self._number(token)
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - p) & 1
            want = i - self.zeros[p] if bit else i  # as many ones (zeros) of plane p lie before the bit looked for
            ones = self.ones[p]
            before = ones if bit else np.minimum(np.arange(len(ones)) * self.block, self.n) - ones
            b = int(np.searchsorted(before, want, "right")) - 1
            b = min(b, len(ones) - 2)
            i = b * self.block + int(np.flatnonzero(self._bits(p, b) == bit)[want - int(before[b])])
        return i

    def occurrences(self, token: int) -> Iterator[int]:
        return (self.select(token, k) for k in range(self.count(token)))

    def all_ids(self) -> np.ndarray:
        """Every token: from the last plane up, each plane's order is put back."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for p in range(self.planes - 1, -1, -1):
            bits = (np.concatenate([self._read_block(p, k) for k in range(len(self.ends[p]))]) if self.n
                    else np.zeros(0, np.uint8)).view(bool)
            up, z = np.empty_like(ids), self.zeros[p]
            up[np.flatnonzero(~bits)] = ids[:z]
            up[np.flatnonzero(bits)] = ids[z:] | kind(1 << (self.planes - 1 - p))
            ids = up
        return self.alphabet[ids].astype(np.uint32)


# ---- files in the shared folder

def _located(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[a-z][a-z0-9+.-]*:/", path):
        path = re.sub(r"^file:/+", "file:///", path)
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark resolves it: one without a scheme may be on the cluster's own."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def put(path: str, raw: bytes) -> None:
    """Write under a temporary name, then move: a reader never sees half a file."""
    store, p = _located(path)
    tmp = f"{os.path.dirname(p)}/_{uuid.uuid4().hex}"
    with store.open_output_stream(tmp) as f:
        f.write(raw)
    store.move(tmp, p)


def get(path: str) -> bytes:
    store, p = _located(path)
    with store.open_input_stream(p) as f:
        return f.read()


# ---- encoding

def encoder(path: str):
    """:func:`make_encoder`, kept by a worker process."""
    return kept(f"encoder {path}", lambda: make_encoder(path))


def make_encoder(path: str):
    """Encodes texts with the tokenizers library; pieces seen of late are remembered.

    A new piece of letters is one word of the pattern, and a piece of printable ASCII is cut by the
    pattern itself: the library's model gets such words as they are, without the library's normalizing
    and splitting.  All other pieces, and those that may hold a special token, go through all of the library.

    A blank between two other characters always starts a new word of the byte-level pattern,
    so the pieces between such places are encoded one by one.  Most texts have no other blanks
    and are cut at each of them; ``blank`` then stands for a blank and the piece after it.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    cut = re.compile(r"(?<=\S)(?= \S)")
    plain = re.compile(r"[!-~\n]+")
    # fixed value: the pattern of byte-level files
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.A)
    # byte-level vocabularies split by this rule only; any other file is asked for whole texts
    added = tok.get_added_tokens_decoder().values()
    by_piece = (b'"type":"ByteLevel","add_prefix_space":false' in tok.pre_tokenizer.__getstate__()
                and tok.normalizer is None
                and not any(" " in t.content or t.lstrip or t.rstrip or t.single_word for t in added))

    def packed(text: str) -> bytes:
        ids = tok.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    letters = byte_letters()

    model = tok.model

    lead, formats = letters[32], [f"<{n}I" for n in range(64)]

    def merged(text: str) -> bytes:
        """The model's ids of one word in the letters of the vocabulary."""
        ids = [t.id for t in model.tokenize(text)]
        return struct.pack(formats[len(ids)] if len(ids) < 64 else f"<{len(ids)}I", *ids)

    def word(text: str) -> bytes:
        """One word of the pattern."""
        return merged("".join([letters[b] for b in text.encode()]))

    def after_blank(piece: str) -> bytes | str:
        """Not bytes if the piece is empty or begins or ends with white space: such a text is cut by the pattern."""
        if piece.isalpha():
            return merged(lead + piece) if piece.isascii() else word(" " + piece)
        body = piece.rstrip(".,!?;:*$%&#")
        if body.isalpha():
            return blank[body] + part[piece[len(body):]]
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return ""
        if plain.fullmatch(piece) and "<|" not in piece:
            return b"".join([blank[w[1:]] if w[0] == " " and w[1:].isalpha() else part[w] for w in pattern.findall(" " + piece)])
        return packed(" " + piece)

    known, blank = Remembered(packed, MAX_PIECES // 8), Remembered(after_blank, MAX_PIECES)
    part = Remembered(word, MAX_PIECES // 8)
    end = struct.pack("<I", END_ID)

    def encoded(text: str | None) -> bytes:
        if not text:
            return b""
        if not by_piece:
            return packed(text)
        pieces = iter(text.split(" "))
        first = next(pieces)
        if first and not first[0].isspace() and not first[-1].isspace():
            try:
                return known[first] + b"".join(map(blank.__getitem__, pieces))
            except TypeError:  # one of the pieces is no bytes
                pass
        return b"".join(map(known.__getitem__, cut.split(text)))

    return lambda texts: (encoded(t) + end for t in texts)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write_shards(docs: DataFrame, out: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shard files into ``out``; part, seq, path, n_docs, n_tokens of each."""
    tokenizer = tokenizer or default_path()
    out = qualified(docs.sparkSession, out)
    store, p = _located(out)
    store.create_dir(p, recursive=True)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer)
        ids, docs_in, lens, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            path = f"{out}/part-{part:06d}-{seq:06d}.wmx"
            put(path, build(np.frombuffer(b"".join(ids), "<u4"), docs_in, lens))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([path]),
                 pa.array([len(docs_in)], pa.int64()), pa.array([size], pa.int64())],
                names=["part", "seq", "path", "n_docs", "n_tokens"])

        for b in in_slices(batches):
            for d, raw in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                ids.append(raw)
                docs_in.append(d)
                lens.append(len(raw) // 4)
                size += lens[-1]
                if size >= shard_tokens:
                    yield flush()
                    ids, docs_in, lens, size, seq = [], [], [], 0, seq + 1
        if docs_in:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               # ranges cut by the first characters too, so that the rows of one id need not be one task's
               .repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text"))
    return staged(ordered.mapInArrow(written, "part long, seq long, path string, n_docs long, n_tokens long"), "shards")


def with_starts(shards: DataFrame) -> DataFrame:
    """path and start (tokens of all shards before it)."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return shards.join(parts, "part").select("path", (F.col("before") + inside).alias("start"))


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for f in frames:
            for path, start in zip(f["path"], f["start"], strict=True):
                w = WaveletFile(get(path))
                raw = w.all_ids().astype("<u4")
                ends = np.cumsum(w.lengths)
                yield pd.DataFrame({
                    "doc_id": pd.array(w.doc_ids, "Int64"), "start": start + ends - w.lengths, "n_tokens": w.lengths,
                    "ids_crc32": np.array([crc32(raw[e - n:e]) for e, n in zip(ends, w.lengths, strict=True)], np.int64)})

    files = with_starts(shards).repartition(max(1, shards.count() // FILES_A_TASK), "path")
    return files.mapInPandas(found, "doc_id long, start long, n_tokens long, ids_crc32 long")


def binary_output(docs: DataFrame, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write all documents as shard files into a new folder of the shared one and read them back."""
    out = new_path(docs.sparkSession, "tokens")
    return read_documents(write_shards(docs, out, tokenizer, shard_tokens))
