"""Phrase collocations by SETM: occurrence relations, merge-joined, counted and cut down length by length.

``R1`` holds every word occurrence as (piece, position, word), sorted, written once.  For each length:
the groups (phrases) of ``Rk`` are counted over the whole corpus; a semi-join with the frequent ones
leaves the occurrences worth extending, which are written again; a merge-join of those with themselves on
the same piece and the next position gives the occurrences of ``Rk+1``, whose groups are named by the
pair of their first and last k words.  A phrase is frequent only if both are, so nothing is lost.

How the work is spread:

* A piece never leaves its document, so a relation is kept in chunks of at most ``CHUNK`` bytes of text
  (of one language), each a row of packed columns.  Positions run on through a chunk and skip
  one between pieces: the next position is the same piece's next word.
* A chunk sends each of its groups once, with its count (a third of all words may be one word: it is one
  entry a chunk), to one of ``ranges`` hash ranges, whose number follows the corpus.  A range sums
  them, numbers the frequent groups and sends the numbers back to the chunks that asked.
* Scores need the frequent groups only; they are tables of rows, joined by number.

Defined results: null text has no words, a null lang is ``und``; a lang without candidates has no rows;
repeated documents count again; equal scores and counts are ordered by phrase; an empty table gives
an empty result.  Other columns are not read.  A piece longer than ``CHUNK`` bytes is a chunk of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import forget, staged

LONGEST, LEAST, TOP = 4, 30, 2000  # fixed values of the contract
COVERED, SCALE = 80, 2_000_000
ENDS = b".,;:!?\n\v\f\r"
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(ENDS) + b" ")
CHUNK = 4 << 20
RANGE_GROUPS = 1_500_000  # word occurrences a hash range stands for
PARTS = 16


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _pack_sorted(values: np.ndarray, kind: str) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)).astype(kind))


def _unpack_sorted(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(_unpack(data, kind).astype(np.int64))


class _Numbers(dict):
    """Words numbered as they come; marks have numbers below 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 2
        return n


def occurrences(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, positions (one is skipped between pieces) and word numbers of folded text."""
    numbers = _Numbers({b"": -1, b"\n": -2})
    words = data.replace(b"\n", b" \n ").split(b" ")
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    kept = ids >= 0
    piece = np.cumsum(ids == -2)[kept]
    return list(numbers)[2:], np.arange(len(piece)) + piece, ids[kept]


def _cut(text: bytes, most: int) -> Iterator[bytes]:
    """A folded text in parts of at most ``most`` bytes that end between pieces (longer pieces whole)."""
    at = 0
    while len(text) - at > most:
        end = text.rfind(b"\n", at, at + most)
        if end < 0:
            end = text.find(b"\n", at + most)
            if end < 0:
                break
        yield text[at:end + 1]
        at = end + 1
    yield text[at:]


def first_relation(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """R1 in chunks: chunk, lang, words, counts, pos, idx."""
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.binary())),
                        ("counts", pa.list_(pa.int64())), ("pos", pa.binary()), ("idx", pa.binary())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: dict[str, list[bytes]] = {}
        size: Counter[str] = Counter()
        number = TaskContext.get().partitionId() << 32

        def made(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            words, pos, idx = occurrences(b"\n".join(held.pop(lang)))
            del size[lang]
            if words:
                yield pa.RecordBatch.from_pylist([{
                    "chunk": number, "lang": lang, "words": words, "counts": np.bincount(idx, minlength=len(words)),
                    "pos": _pack_sorted(pos, "<i4"), "idx": _pack(idx.astype("<i4"))}], schema)
                number += 1

        for b in batches:
            for at in range(0, b.num_rows, 256):
                few = b.slice(at, 256)
                for lang, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist(), strict=True):
                    for part in _cut(text.translate(FOLD), chunk):
                        if size[lang] and size[lang] + len(part) > chunk:
                            yield from made(lang)
                        held.setdefault(lang, []).append(part)
                        size[lang] += len(part) + 1
                        if size.total() > 4 * chunk:
                            yield from made(max(size, key=size.get))
        for lang in list(held):
            yield from made(lang)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(chunks, "chunk long, lang string, words array<binary>, counts array<long>, pos binary, idx binary")


def next_groups(pos: np.ndarray, idx: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a sorted relation with itself on the next position.

    Returns the position of each match, the number of its group, and the groups as pairs (key // n, key % n)
    with their counts."""
    at = np.flatnonzero(pos[1:] == pos[:-1] + 1)
    key, group, count = np.unique(idx[at] * n + idx[at + 1], return_inverse=True, return_counts=True)
    return pos[at], group, key, count


def _range_of(a: np.ndarray, b: np.ndarray, ranges: int) -> np.ndarray:
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(33)) % np.uint64(ranges)).astype(np.int64)


STEP = "sent boolean, chunk long, pos binary, idx binary, gids binary, r int, a binary, b binary, n binary"


def _step(chunk: int, pos: np.ndarray, gid: np.ndarray, ranges: int) -> pd.DataFrame:
    """A chunk's frequent occurrences as a relation row, and its next groups, one row a range."""
    gids, idx = np.unique(gid, return_inverse=True)
    _, _, key, count = next_groups(pos, idx, max(len(gids), 1))
    a, b = (gids[key // len(gids)], gids[key % len(gids)]) if len(key) else (gids[:0], gids[:0])
    rows = [(False, chunk, _pack_sorted(pos, "<i4"), _pack(idx.astype("<i4")), _pack_sorted(gids, "<i8"), None, None, None, None)]
    r = _range_of(a, b, ranges)
    order = np.argsort(r, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(r[order])) + 1) if len(key) else ():
        rows.append((True, chunk, None, None, None, int(r[own[0]]), _pack_sorted(a[own], "<i8"), _pack(b[own].astype("<i8")),
                     _pack(count[own].astype("<i8"))))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in STEP.split(", ")])


def _after_words(ranges: int):
    """Semi-join of R1 with the frequent words, and the step to pairs."""
    def step(rel: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(rel) or not len(found):
            return pd.DataFrame(columns=[c.split()[0] for c in STEP.split(", ")])
        pos, idx = _unpack_sorted(rel.pos[0], "<i4"), _unpack(rel.idx[0], "<i4")
        gid_of = np.full(int(rel.n_words[0]), -1, np.int64)
        gid_of[found.idx.to_numpy()] = found.gid.to_numpy()
        gid = gid_of[idx]
        return _step(int(rel.chunk[0]), pos[gid >= 0], gid[gid >= 0], ranges)
    return step


def _after_groups(ranges: int):
    """Semi-join of the next relation with its frequent groups, and the step to longer ones."""
    def step(rel: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(rel) or not len(found):
            return pd.DataFrame(columns=[c.split()[0] for c in STEP.split(", ")])
        gids = _unpack_sorted(rel.gids[0], "<i8")
        pos, group, key, _ = next_groups(_unpack_sorted(rel.pos[0], "<i4"), _unpack(rel.idx[0], "<i4").astype(np.int64), len(gids))
        r = _range_of(gids[key // len(gids)], gids[key % len(gids)], ranges)
        order = np.argsort(r, kind="stable")
        starts = np.searchsorted(r[order], np.arange(ranges))
        gid_of = np.full(len(key), -1, np.int64)
        for k, at, gid in zip(found.r, found["at"], found.gids, strict=True):
            gid_of[order[starts[k] + _unpack(at, "<i4")]] = _unpack_sorted(gid, "<i8")
        gid = gid_of[group]
        return _step(int(rel.chunk[0]), pos[gid >= 0], gid[gid >= 0], ranges)
    return step


COUNTED = "chunk long, r int, at binary, gids binary, a binary, b binary, f binary"


def _count(least: int):
    """The groups of one hash range: sums over all chunks; frequent ones are numbered and sent back."""
    def count(packs: pd.DataFrame) -> pd.DataFrame:
        r = int(packs.r[0])
        a = [_unpack_sorted(x, "<i8") for x in packs.a]
        sizes = [len(x) for x in a]
        a, b, n = np.concatenate(a), np.concatenate([_unpack(x, "<i8") for x in packs.b]), np.concatenate([_unpack(x, "<i8") for x in packs.n])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        first = np.flatnonzero(new)
        f = np.add.reduceat(n[order], first)
        frequent = f >= least
        gid = np.where(frequent, (r << 32) + np.cumsum(frequent) - 1, -1)
        of_entry = np.empty(len(order), np.int64)
        of_entry[order] = gid[np.cumsum(new) - 1]
        names = [c.split()[0] for c in COUNTED.split(", ")]
        rows = []
        if frequent.any():
            rows.append((None, r, None, _pack_sorted(gid[frequent], "<i8"), _pack_sorted(a[first][frequent], "<i8"),
                         _pack(b[first][frequent].astype("<i8")), _pack(f[frequent].astype("<i8"))))
        for chunk, part in zip(packs.chunk, np.split(of_entry, np.cumsum(sizes)[:-1]), strict=True):
            at = np.flatnonzero(part >= 0)
            if len(at):
                rows.append((int(chunk), r, _pack(at.astype("<i4")), _pack_sorted(part[at], "<i8"), None, None, None))
        out = pd.DataFrame(rows, columns=names)
        out["chunk"] = out["chunk"].astype("Int64")
        return out
    return count


def _group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent groups as rows: id, a, b, f."""
    for batch in batches:
        for gids, a, b, f in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(_unpack_sorted(gids, "<i8")), pa.array(_unpack_sorted(a, "<i8")),
                                              pa.array(_unpack(b, "<i8")), pa.array(_unpack(f, "<i8"))], names=["id", "a", "b", "f"])


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, chunk: int = CHUNK,
                     range_groups: int = RANGE_GROUPS) -> tuple[DataFrame, list[DataFrame]]:
    """The words (id, lang, word, f; id null below ``least``), and for each length from 2 the frequent phrases
    as id, a, b (ids of the first and last words but one), f."""
    r1 = staged(first_relation(docs, chunk), "setm-r1")
    own = r1.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("idx", "w"))
    own = own.select("chunk", "lang", "idx", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    words = own.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    words = staged(words.withColumn("id", F.when(F.col("f") >= least, F.monotonically_increasing_id())), "setm-words")
    total = words.agg(F.sum("f")).first()[0] or 0
    ranges = max(1, -(-total // range_groups))

    found = own.join(words.where("id is not null"), ["lang", "word"]).select(F.col("chunk").alias("of"), "idx", F.col("id").alias("gid"))
    rel = r1.select("chunk", "pos", "idx", F.size("words").alias("n_words"))
    step, lengths = _after_words(ranges), []
    for k in range(2, longest + 1):
        state = staged(rel.groupBy("chunk").cogroup(found.groupBy("of")).applyInPandas(step, STEP), f"setm-r{k - 1}")
        counted = staged(state.where("sent").select("chunk", "r", "a", "b", "n").groupBy("r")
                         .applyInPandas(_count(least), COUNTED), f"setm-c{k}")
        lengths.append(counted.where("chunk is null").select("gids", "a", "b", "f")
                       .mapInArrow(_group_rows, "id long, a long, b long, f long"))
        rel = state.where("not sent").select("chunk", "pos", "idx", "gids")
        found = counted.where("chunk is not null").select(F.col("chunk").alias("of"), "r", "at", "gids")
        step = _after_groups(ranges)
    return words, lengths


def _score(a: Column, cut: Column) -> Column:
    """floor(SCALE * a / cut) without rounding: both sides are whole numbers of up to 38 digits."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * a.cast("decimal(19,0)"), cut.cast("decimal(20,0)"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered: int = COVERED,
                 chunk: int = CHUNK, range_groups: int = RANGE_GROUPS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's ``top`` phrases."""
    words, lengths = frequent_phrases(docs, longest, least, chunk, range_groups)
    one = F.array("f")
    # pre[k - 1] and suf[k - 1]: how often the first and the last k words occur
    table = words.where("id is not null").select("id", "lang", F.col("word").cast("string").alias("phrase"), one.alias("pre"),
                                                 one.alias("suf"), F.col("word").cast("string").alias("last"))
    scored = []
    for m, groups in enumerate(lengths, 2):
        head = table.select(F.col("id").alias("a"), "lang", "phrase", "pre")
        tail = table.select(F.col("id").alias("b"), "suf", "last")
        table = staged(groups.join(head, "a").join(tail, "b").select(
            "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), F.concat("pre", one).alias("pre"),
            F.concat("suf", one).alias("suf"), "last", "f"), f"setm-t{m}")
        cuts = [F.struct(_score(F.col("f"), F.col("pre")[k - 1].cast("decimal(19,0)") + F.col("suf")[m - k - 1]).alias("score"), F.lit(k).alias("k"),
                         F.col("pre")[k - 1].alias("l"), F.col("suf")[m - k - 1].alias("r")) for k in range(1, m)]
        out = table.select("id", "lang", "phrase", F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("cut"))
        if m < longest:  # a phrase inside a much longer one is inside one that is a word longer and as frequent
            longer = lengths[m - 1].select(F.explode(F.array_distinct(F.array("a", "b"))).alias("id"), "f")
            out = out.join(longer.groupBy("id").agg(F.max("f").alias("longer")), "id", "left")
            big = lambda c: F.col(c).cast("decimal(19,0)")
            out = out.where(F.coalesce(big("longer") * 100 < big("a") * covered, F.lit(True)))
        scored.append(out.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    # a lang's phrases are ranked in PARTS parts first, so at most PARTS * top of them meet in one task
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = lambda df, *by: (df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
                              .where(F.col("rank") <= top))
    best = reduce(DataFrame.unionByName, scored).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = ranked(ranked(best, "lang", "part").drop("part", "rank"), "lang")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def brute_force(rows: list[tuple], longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> list[tuple]:
    """The same by plain counting, for tests: rows of (lang, text)."""
    import re

    count: dict[str, Counter] = {}
    n: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        c = count.setdefault(lang, Counter())
        folded = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                c.update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, c in count.items():
        candidates = {p: f for p, f in c.items() if len(p) > 1 and f >= least}
        dropped = {p[i:j] for p, f in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and 100 * f >= covered * candidates[p[i:j]]}
        kept = []
        for p, f in candidates.items():
            if p not in dropped:
                s, k = min((SCALE * f // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-s, -f, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -f, le, ri, n[lang], -s) for i, (s, f, p, le, ri) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def oracle() -> str:
    """DuckDB SQL of the collocations of ``documents``."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, unnest(list_transform(range(1, len(w) - {m - 2}), lambda i: array_to_string(w[i:i + {m - 1}], ' '))) AS p FROM pieces"
        for m in range(1, LONGEST + 1))
    return f"""
WITH folded AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM folded),
counts AS MATERIALIZED (SELECT lang, m, p, count(*) AS f FROM ({grams}) GROUP BY lang, m, p),
cand AS MATERIALIZED (SELECT lang, m, p, f, string_split(p, ' ') AS w FROM counts WHERE m > 1 AND f >= {LEAST}),
starts AS (SELECT lang, f, m, w, unnest(range(1, m)) AS i FROM cand),
subs AS (SELECT lang, f, m, w, i, unnest(range(i + 1, m + 1)) AS j FROM starts),
parts AS (SELECT lang, array_to_string(w[i:j], ' ') AS p, max(f) AS f FROM subs WHERE j - i + 1 < m GROUP BY 1, 2),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN parts s ON s.lang = c.lang AND s.p = c.p
  WHERE s.f IS NULL OR 100 * s.f::HUGEINT < {COVERED} * c.f::HUGEINT),
cut AS (SELECT lang, p, f, w, m, unnest(range(1, m)) AS k FROM kept),
halves AS (SELECT lang, p, f, k, array_to_string(w[1:k], ' ') AS a, array_to_string(w[k + 1:], ' ') AS b FROM cut),
cuts AS (
  SELECT c.lang, c.p, c.f, k, l.f AS l, r.f AS r, ({SCALE} * c.f::HUGEINT) // (l.f + r.f) AS score
  FROM halves c JOIN counts l ON l.lang = c.lang AND l.p = c.a JOIN counts r ON r.lang = c.lang AND r.p = c.b),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, p) AS rank FROM best)
SELECT x.lang, x.rank::BIGINT AS rank, p AS phrase, f::BIGINT AS a, x.l::BIGINT AS l, x.r::BIGINT AS r, t.n::BIGINT AS n, score::BIGINT AS score
FROM ranked x JOIN (SELECT lang, sum(f) AS n FROM counts WHERE m = 1 GROUP BY lang) t ON t.lang = x.lang
WHERE rank <= {TOP}
"""
