"""Conversation prefix trie by range minima over sorted LCPs.

A conversation is a sequence of turns, a node of the trie a distinct sequence of first turns.
Sequences are sorted, so the members of a node are one interval of them: it reaches as far left and
right as neighbouring sequences have at least ``depth`` turns in common.  A sparse table of minima
over the neighbours' common lengths (LCPs) answers that for a jump of any power of two, so every
candidate prefix finds its two ends by binary search, each by itself and without a stack.

How the work is spread:

1. A turn is named by 128 bits of the SHA-256 of its role and text; texts are read once and never
   shuffled.  A conversation becomes one row of such names, equal conversations become one class
   (combined before the shuffle) with its number, smallest id and the hash of its ids.
2. Classes are sorted by ranges of names and cut into blocks of at most ``BLOCK`` classes and
   ``BLOCK_TURNS`` turns (a single longer conversation is a block of its own).  A block knows its
   neighbours' nearest sequences, so intervals that end inside it are complete at once.
3. Prefixes whose interval crosses a block's edge are a chain of at most as many rows as its edge
   sequences have turns in common; their parts are summed by prefix, and what one block adds to the
   chain is summed along it.  A prefix that a third of all conversations share is many blocks'
   edges, never one group.
4. The ids that end at a node are sorted by ranges of (class, id) and joined into texts of
   ``IDS`` ids there; only these texts meet in one task, which hashes them as a stream.

Bounds: the names and sizes (20 bytes a turn) of one conversation fit in one row.

Defined results: rows without conv_id are no conversation; equal turns of a conversation are ordered by
role, then by the hash of role and text; repeated rows are turns of their own; null role or text is
empty text; a conversation without any turn left counts for the root alone; an empty table has no
node at all, not even the root.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import forget, staged

NAME = 16  # bytes of a turn's name
FAMILY, FOLDS = 5, 9  # fixed values of the contract
BLOCK, BLOCK_TURNS = 20_000, 200_000
IDS = 4096
NO_ID = hashlib.sha256(b"").hexdigest()
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, names and sizes (UTF-8 bytes of the text) of every conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * NAME).alias("name"),
        F.octet_length(text).alias("size"))
    row = F.sort_array(F.collect_list(F.struct("turn", "role", "name", "size")))
    return turns.groupBy("conv_id").agg(row.alias("t")).select("conv_id", F.col("t.name").alias("names"),
                                                               F.col("t.size").alias("sizes"))


def rebuilt(seqs: DataFrame, family: int = FAMILY, folds: int = FOLDS) -> DataFrame:
    """Every conversation with its first turns taken from the first one of its family.

    The family's head is at most ``folds - 1`` turns: it meets its (at most 2 * family - 1) members by
    a window over the family."""
    first = F.col("conv_id") - F.col("conv_id") % family
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % folds).cast("int")
    lead = F.max(F.when(F.col("conv_id") == F.col("first"), F.struct(
        F.slice("names", 1, folds - 1).alias("names"), F.slice("sizes", 1, folds - 1).alias("sizes"))))
    rows = seqs.withColumn("first", first).withColumn("h", h)
    rows = rows.withColumn("lead", lead.over(Window.partitionBy("first")))

    def joined(c: str, of: str):
        head = F.coalesce(F.slice(f"lead.{c}", F.lit(1), F.col("h")), F.array().cast(f"array<{of}>"))
        return F.concat(head, F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0))))

    return rows.select("conv_id", F.unhex(F.array_join(joined("names", "string"), "")).alias("seq"),
                       joined("sizes", "int").alias("sizes"))


def joined_ids(members: DataFrame) -> DataFrame:
    """cls, sha256 of its conv_ids in ascending order, joined by commas.

    Ranges of (cls, conv_id) cut a hot class among tasks; each joins its ids into texts of ``IDS``
    ids, which are hashed in order as a stream."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        cls, ids, out = None, [], []

        def rows():
            return pa.RecordBatch.from_pylist(out, pa.schema([("cls", pa.binary()), ("at", pa.int64()), ("ids", pa.string())]))

        for b in batches:
            for c, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if c != cls or len(ids) == IDS:
                    if ids:
                        out.append({"cls": cls, "at": ids[0], "ids": ",".join(map(str, ids))})
                    cls, ids = c, []
                ids.append(i)
                if len(out) == 1024:
                    yield rows()
                    out.clear()
        if ids:
            out.append({"cls": cls, "at": ids[0], "ids": ",".join(map(str, ids))})
        yield rows()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, state = None, None
        for b in batches:
            keys, ends = [], []
            for c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if c != cls:
                    if cls is not None:
                        keys.append(cls)
                        ends.append(state.hexdigest())
                    cls, state = c, hashlib.sha256(t.encode())
                else:
                    state.update(b"," + t.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], names=["cls", "ends"])
        if cls is not None:
            yield pa.RecordBatch.from_arrays([pa.array([cls], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                             names=["cls", "ends"])

    parts = (members.select("cls", "conv_id").repartitionByRange("cls", "conv_id").sortWithinPartitions("cls", "conv_id")
             .mapInArrow(texts, "cls binary, at long, ids string"))
    return (parts.repartition("cls").sortWithinPartitions("cls", "at").select("cls", "ids")
            .mapInArrow(hashed, "cls binary, ends string"))


BLOCK_SCHEMA = ("part int, block long, lengths binary, seqs binary, sizes binary, ids binary, counts binary, ends binary, "
                "before binary, after binary, first binary, last binary")


def packed(batches: Iterator[pa.RecordBatch], most: int, most_turns: int) -> Iterator[pa.RecordBatch]:
    """Sorted classes as blocks; ``before`` and ``after`` are the nearest sequences of the same range."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64())] + [
        (c.split()[0], pa.binary()) for c in BLOCK_SCHEMA.split(", ")[2:]])
    rows: list[tuple] = []
    turns, number, before = 0, 0, None

    def block(after: bytes | None) -> pa.RecordBatch:
        seqs = [r[0] for r in rows]
        one = {"part": part, "block": (part << 32) + number, "seqs": b"".join(seqs),
               "lengths": np.array([len(s) // NAME for s in seqs], "<i4").tobytes(),
               "sizes": np.concatenate([np.asarray(r[1], "<i4") for r in rows]).astype("<i4").tobytes(),
               "ids": np.array([r[2] for r in rows], "<i8").tobytes(), "counts": np.array([r[3] for r in rows], "<i8").tobytes(),
               "ends": b"".join(bytes.fromhex(r[4]) for r in rows), "before": before, "after": after,
               "first": seqs[0], "last": seqs[-1]}
        return pa.RecordBatch.from_pylist([one], schema)

    for b in batches:
        for row in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            if rows and (len(rows) == most or turns + len(row[0]) // NAME > most_turns):
                yield block(row[0])
                before, number, turns = rows[-1][0], number + 1, 0
                rows.clear()
            rows.append(row)
            turns += len(row[0]) // NAME
    if rows:
        yield block(None)


class RangeMinima:
    """Sparse table: the least value of any interval, from two overlapping powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [np.asarray(values)]
        while 2 << (len(self.rows) - 1) <= len(values):
            half, last = 1 << (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))
        self.flat = np.concatenate(self.rows)
        self.starts = np.cumsum([0] + [len(r) for r in self.rows[:-1]])

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least value of positions a to b (both included)."""
        k = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        at = self.starts[k]
        return np.minimum(self.flat[at + a], self.flat[at + b - (1 << k) + 1])

    def reach(self, at: np.ndarray, least: np.ndarray, step: int) -> np.ndarray:
        """How far each position goes to the right (step 1) or left (-1) over values of at least ``least``:
        ``values[i]`` stands between rows i - 1 and i, so row r is reached from r - 1 over values[r]."""
        at, n = at.copy(), len(self.rows[0])
        for k in range(len(self.rows) - 1, -1, -1):
            jump, row = 1 << k, self.rows[k]
            lo = at + 1 if step > 0 else at - jump + 1
            ok = (lo >= 1) & (lo + jump <= n)
            ok[ok] = row[lo[ok]] >= least[ok]
            at += np.where(ok, step * jump, 0)
        return at


def common_turns(names: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each sequence has in common with the one before it (0 for the first)."""
    out = np.zeros(len(lengths), np.int64)
    live, d = np.arange(1, len(lengths)), 0
    while len(live):
        live = live[(lengths[live] > d) & (lengths[live - 1] > d)]
        live = live[(names[offsets[live] + d] == names[offsets[live - 1] + d]).all(axis=1)]
        out[live] = d = d + 1
    return out


def shared(a: bytes | None, b: bytes | None) -> int:
    """Turns that two sequences have in common; -1 where there is no other sequence."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // NAME
    x, y = (np.frombuffer(s, "V%d" % NAME, n) for s in (a, b))
    return int((np.append(x != y, True)).argmax())


NODE_SCHEMA = ("block long, depth int, conv_id long, parent_conv_id long, parent_depth int, parent_left boolean, n_convs long, n_children long, "
               "n_leaves long, saved long, size long, ends binary, key binary, is_new boolean, goes_on boolean")


def block_nodes(block: dict) -> pd.DataFrame:
    """The nodes of one block: complete ones, and the parts of those that cross its edges (with a key)."""
    lengths = np.frombuffer(block["lengths"], "<i4").astype(np.int64)
    n, offsets = len(lengths), np.concatenate([[0], np.cumsum(lengths)])
    names = np.frombuffer(block["seqs"], "<u8").reshape(-1, 2)
    sizes = np.append(np.frombuffer(block["sizes"], "<i4").astype(np.int64), 0)
    ids, counts = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["counts"], "<i8")
    lcp = common_turns(names, offsets, lengths)
    left, right = shared(block["before"], block["first"]), shared(block["last"], block["after"])
    lcp[0] = left
    after = np.append(lcp[1:], right)
    minima, least_id = RangeMinima(lcp), RangeMinima(ids)

    # candidates: the prefixes that the block before has too, then those that begin at each row
    new = lengths - lcp
    starts = np.concatenate([[0], np.cumsum(new)]) + left + 1
    row = np.concatenate([np.zeros(left + 1, np.int64), np.repeat(np.arange(n), new)])
    depth = np.concatenate([np.arange(left + 1), np.arange(len(row) - left - 1) - np.repeat(starts[:-1] - left - 1, new)
                            + np.repeat(lcp, new) + 1])
    lo, hi = minima.reach(row, depth, -1), minima.reach(row, depth, 1)
    goes_on = (hi == n - 1) & (depth <= right)
    is_new = np.arange(len(row)) > left
    is_open = goes_on | ~is_new

    members = np.concatenate([[0], np.cumsum(counts)])
    n_convs = members[hi + 1] - members[lo]
    leaves = np.concatenate([[0], np.cumsum(after < lengths)])
    starts_at = np.sort(lcp[1:] * n + np.arange(1, n))  # a child begins where the neighbours part at this depth
    children = (np.searchsorted(starts_at, depth * n + hi, "right") - np.searchsorted(starts_at, depth * n + lo, "right")
                + ((lcp[lo] <= depth) & (depth < lengths[lo])))
    size = np.where(depth > 0, sizes[offsets[row] + depth - 1], 0)
    saved = np.concatenate([[0], np.cumsum(np.where(is_open, 0, (n_convs - 1) * size))])
    at = np.where(is_new, np.arange(len(row)), left + 1)

    # the parent's interval, found from the node's own row
    up = np.maximum(depth - 1, 0)
    plo, phi = minima.reach(row, up, -1), minima.reach(row, up, 1)
    parent_left = (plo == 0) & (up <= left)
    parent_open = parent_left | ((phi == n - 1) & (up <= right))
    parent = np.where(parent_open | (depth == 0), 0, least_id.least(plo, phi))

    own_end = is_new & (lengths[row] == depth)
    ends = np.frombuffer(block["ends"], "V32")
    last, first = block["last"], block["first"]
    keys = [hashlib.blake2b((last if g else first)[:NAME * d], digest_size=16).digest() if o else None
            for o, g, d in zip(is_open.tolist(), goes_on.tolist(), depth.tolist(), strict=True)]
    return pd.DataFrame({
        "block": block["block"], "depth": depth.astype(np.int32), "conv_id": least_id.least(lo, hi),
        "parent_conv_id": parent,
        "parent_depth": np.where(parent_open & (depth > 0), up, -1).astype(np.int32), "parent_left": parent_left,
        "n_convs": n_convs, "n_children": children, "n_leaves": leaves[hi + 1] - leaves[lo],
        "saved": saved[starts[hi + 1]] - saved[at], "size": size,
        "ends": [ends[r].tobytes() if e else None for r, e in zip(row.tolist(), own_end.tolist(), strict=True)],
        "key": keys, "is_new": is_new, "goes_on": goes_on})


def _blocks_to_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    forget()
    for b in batches:
        for block in b.to_dict("records"):
            yield block_nodes(block)


def trie(convs: DataFrame, block: int = BLOCK, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes (``COLUMNS``) of conversations given as conv_id, seq (names), sizes."""
    members = staged(convs.withColumn("cls", F.unhex(F.substring(F.sha2("seq", 256), 1, 32))), "trie-members")
    classes = members.groupBy("cls").agg(F.first("seq").alias("seq"), F.first("sizes").alias("sizes"),
                                         F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    rows = classes.join(joined_ids(members), "cls").select("seq", "sizes", "conv_id", "n", "ends")
    blocks = staged(staged(rows, "trie-classes").repartitionByRange("seq").sortWithinPartitions("seq")
                    .mapInArrow(lambda rows: packed(rows, block, block_turns), BLOCK_SCHEMA), "trie-blocks")

    # the nearest sequences of the neighbouring ranges: one row a range
    edges = blocks.groupBy("part").agg(F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"))
    w = Window.orderBy("part")
    near = edges.select("part", F.lag("last").over(w).alias("__before"), F.lead("first").over(w).alias("__after"))
    blocks = (blocks.join(F.broadcast(near), "part")  # one row a range: the number of partitions bounds it
              .withColumns({"before": F.coalesce("before", "__before"), "after": F.coalesce("after", "__after")})
              .drop("__before", "__after"))
    nodes = staged(blocks.mapInPandas(_blocks_to_nodes, NODE_SCHEMA), "trie-nodes")

    # prefixes that cross edges: parts summed by prefix, then what each block's new ones save, along its chain
    parts = nodes.where("key is not null")
    whole = staged(parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("inside"), F.max("ends").alias("ends"),
        F.max("depth").alias("depth"), F.max("size").alias("size")), "trie-crossing")
    value = whole.select("key", F.col("conv_id").alias("least"), ((F.col("n_convs") - 1) * F.col("size")).alias("v"))
    chain = parts.select("key", "block", "depth", "is_new", "goes_on").join(value, "key")
    deeper = Window.partitionBy("block").orderBy(F.col("depth").desc())
    along = (chain.where("goes_on").select("key", F.sum(F.when(F.col("is_new"), F.col("v")).otherwise(0)).over(deeper).alias("v"))
             .groupBy("key").agg(F.sum("v").alias("across")))
    crossing = whole.join(along, "key", "left").withColumn("saved", F.col("inside") + F.coalesce("across", F.lit(0)))

    # parents: known inside the block, else the chain's prefix at that depth
    lead = chain.select("block", F.col("depth").alias("parent_depth"), (~F.col("is_new")).alias("parent_left"), "least")
    asked = nodes.where("parent_depth >= 0 and (key is null or is_new)")
    found = (asked.select("block", "depth", "conv_id", "parent_depth", "parent_left", "key", "n_convs", "n_children",
                          "n_leaves", "saved", "ends")
             .join(lead, ["block", "parent_depth", "parent_left"]).withColumn("parent_conv_id", F.col("least")))
    names = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")
    parent_known = F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id")
    inside = nodes.where("key is null and parent_depth < 0").withColumn("parent_conv_id", parent_known).select(*names)
    inside = inside.unionByName(found.where("key is null").select(*names))
    of_crossing = (found.where("key is not null").select("key", "parent_conv_id").unionByName(
        nodes.where("key is not null and is_new and parent_depth < 0").select("key", parent_known)))
    across = crossing.join(of_crossing, "key").select(*names)
    return inside.unionByName(across).select(
        F.col("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce(F.lower(F.hex("ends")), F.lit(NO_ID)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, block: int = BLOCK, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(sequences(conversations)), block, block_turns)


def brute_force(rows: list[tuple], family: int = FAMILY, folds: int = FOLDS) -> list[tuple]:
    """The same by plain dictionaries, for tests: rows of (conv_id, turn, role, text)."""
    from zlib import crc32

    def name(role: str, text: str) -> str:
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:2 * NAME]

    own: dict[int, list] = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", name(role or "", text or ""), text or ""))
    convs = {}
    for c in own:
        h = crc32(str(c).encode()) % folds
        first = c - int(np.fmod(c, family))
        convs[c] = [(x[2], x[4]) for x in sorted(own.get(first, []))[:h] + sorted(own[c])[h:]]
    nodes: dict[tuple, list[int]] = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = {p: [min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), 0, 0, 0,
               hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()]
           for p, m in nodes.items()}
    for p in nodes:
        if p:
            out[p[:-1]][4] += 1
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            out[p[:d]][5] += not out[p][4]
            out[p[:d]][6] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((tuple(v) for v in out.values()), key=repr)


def oracle() -> str:
    """DuckDB SQL of the trie of ``conversations``."""
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
named AS (
  SELECT conv_id, turn, role, substr(sha256(strlen(role)::VARCHAR || ':' || role || text), 1, {2 * NAME}) AS name,
         strlen(text) AS size FROM t),
own AS (
  SELECT conv_id, list(name ORDER BY turn NULLS FIRST, role, name) AS names,
         list(size ORDER BY turn NULLS FIRST, role, name) AS sizes FROM named GROUP BY conv_id),
folded AS (
  SELECT *, conv_id - conv_id % {FAMILY} AS first, xor(list_reduce(
      flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: list_concat([ascii(c)], list_transform(range(8), lambda k: -1)))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
      4294967295::BIGINT), 4294967295::BIGINT) % {FOLDS} AS h FROM own),
convs AS (
  SELECT c.conv_id, list_concat(coalesce(f.names[1:c.h], []), c.names[c.h + 1:]) AS names,
         list_concat(coalesce(f.sizes[1:c.h], []), c.sizes[c.h + 1:]) AS sizes
  FROM folded c LEFT JOIN own f ON f.conv_id = c.first),
steps AS (SELECT conv_id, names, sizes, unnest(range(0, len(names) + 1)) AS depth FROM convs),
prefixes AS (
  SELECT conv_id, depth, array_to_string(names[1:depth], '') AS key,
         CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size, len(names) = depth AS ends FROM steps),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth),
kids AS (SELECT substr(key, 1, {2 * NAME} * (depth::INT - 1)) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
above AS (
  SELECT substr(x.key, 1, {2 * NAME} * x.up) AS key, sum(x.leaf) AS n_leaves, sum(x.saved) AS saved FROM (
    SELECT m.key, (m.n - 1) * m.size AS saved, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf,
           unnest(range(0, m.depth + 1))::INT AS up FROM nodes m LEFT JOIN kids k ON k.key = m.key) x GROUP BY 1)
SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n::BIGINT AS n_convs,
       coalesce(k.n, 0)::BIGINT AS n_children, a.n_leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, m.ends_sha256
FROM nodes m JOIN above a ON a.key = m.key LEFT JOIN kids k ON k.key = m.key
LEFT JOIN nodes p ON m.depth > 0 AND p.depth = m.depth - 1 AND p.key = substr(m.key, 1, {2 * NAME} * (m.depth::INT - 1))
"""
