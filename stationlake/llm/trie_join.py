"""N-gram Jaccard join: globally ordered shingle sets in a prefix tree.

Documents link when 100 * |intersection| >= 80 * |union| of their sets of distinct five-word
shingles (64-bit hashes).  Every link between different texts is found:

1. Equal word sequences form a class (a 64-bit hash names it); one text a class goes on.
2. Shingles are counted over all classes.  Each part of the classes sends its distinct hashes,
   sorted and packed, to the hash range they belong to; a range sums them up and answers each
   part with those that occur in at least two classes.  One-class shingles cannot link anything.
3. A set's global order is by count, then hash, rarest first.  Two sets that link share a
   shingle within their first n - ceil(0.8 n) + 1; only these prefixes are compared, and classes
   that share a prefix shingle, directly or over others, make a cluster.  A class whose prefix
   holds one-class shingles only has no partner.
4. Clusters of at most ``BLOCK`` classes are joined whole, larger ones are dealt to blocks: each
   block by itself, then one class a component of every block, and at last every class outside the
   cluster's largest component against all blocks, in chunks.  No pair of classes that might link
   is left out but for pairs that are already connected, whose link changes no component.
5. A block is stored as a trie of the ordered sets and walked once from the root: all probes carry
   their overlap with the path, shared by the subtree below.  A probe leaves a subtree when its
   overlap and the remaining lengths cannot reach the threshold, or when it is already connected to
   all of it; what is left at a set's end is an exact link.
6. Links connect classes, classes their documents; a component is named by its least doc_id.

Edge cases: A-Z count as lower case; fewer than five words are one shingle; null and
wordless texts have an empty set and link with nothing (component: the own id); repeated rows and
ids are rows of their own; a null id is its own component unless linked to a row with an id; an
empty table gives an empty result; texts of any length are taken whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stationlake.llm.common import Remembered, in_slices, kept, put_back, set_apart, staged
from stationlake.llm.graph import components

SIZE = 5
PERCENT = 80
PART = 1500  # classes a part
RANGE = 2_000_000  # shingles a hash range
BLOCK = 1024  # classes a block
_SHIFT = np.uint64(16)  # hashes are counted by their upper 48 bits: a shared value counts too much, never too little


# ---- sets

def word_hashes() -> Remembered:
    """64-bit hashes of the words seen of late."""
    return kept("word hashes", lambda: Remembered(xxhash.xxh3_64_intdigest, 100_000))


def shingles(toks: list[bytes], size: int = SIZE) -> np.ndarray:
    """The distinct shingle hashes of a word sequence, sorted."""
    if not toks:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(word_hashes().__getitem__, toks), np.uint64, len(toks))
    n = min(size, len(h))
    acc = h[:len(h) - n + 1] + np.uint64(n)
    for k in range(1, n):
        acc = (acc ^ (acc >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k]
    acc = (acc ^ (acc >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(acc ^ (acc >> np.uint64(32)))


def lowered(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def class_of(toks: list[bytes]) -> int | None:
    """The signed 64-bit name of a word sequence; None without words."""
    if not toks:
        return None
    h = xxhash.xxh3_64_intdigest(b" ".join(toks))
    return h - (1 << 64) if h >> 63 else h


def links(inter: int, n: int, m: int, percent: int = PERCENT) -> bool:
    return 100 * inter >= percent * (n + m - inter)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


# ---- packed sorted numbers

def pack(values: np.ndarray) -> bytes:
    """Ascending numbers as byte planes of their differences, compressed."""
    d = np.diff(values.astype("<u8"), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<u4").tobytes())


def unpack_counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<u4")


# ---- 1: classes

def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, cls, n_words, words of every row; the packed words only where a task first meets a class."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, met = zstandard.ZstdCompressor(level=1), set()
        for b in in_slices(batches):
            cls, n, text = [], [], []
            for t in b.column(1).to_pylist():
                toks = lowered(t)
                c = class_of(toks)
                cls.append(c)
                n.append(len(toks))
                text.append(press.compress(b" ".join(toks)) if c is not None and c not in met else None)
                met.add(c)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.int64()), pa.array(n, pa.int64()),
                                              pa.array(text, pa.binary())], names=["doc_id", "cls", "n_words", "words"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        signed, "doc_id long, cls long, n_words long, words binary")


# ---- 2 and 3: counts, order, prefixes

def prefixes(sigs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """cls, n of every class; shared (its ordered shingles of at least two classes) and prefix where it may have a partner."""
    total = sigs.where("words is not null").agg(F.count("*").alias("k"), F.sum("n_words").alias("s")).first()
    parts, ranges = max(1, -(-total.k // PART)), max(1, -(-(total.s or 0) // RANGE))
    classes = sigs.where("words is not null").select("cls", "words", F.expr(f"pmod(xxhash64(cls), {parts})").alias("p"))

    def sets(frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
        frame = frame.drop_duplicates("cls")
        unzip = zstandard.ZstdDecompressor()
        for c, raw in zip(frame["cls"], frame["words"], strict=True):
            yield c, shingles(unzip.decompress(raw).split(), size)

    def sent(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        every = [np.unique(s >> _SHIFT) for _, s in sets(frame)]
        values, counts = np.unique(np.concatenate(every), return_counts=True)
        of = ((values >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(32)
        cuts = np.searchsorted(of, np.arange(ranges + 1))
        out = [(r, key[0], pack(values[a:b]), pack_counts(counts[a:b]))
               for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pd.DataFrame(out, columns=["r", "p", "vals", "counts"])

    def summed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        vals = [unpack(x) for x in frame["vals"]]
        counts = np.concatenate([unpack_counts(x) for x in frame["counts"]]).astype(np.int64)
        values, inv = np.unique(np.concatenate(vals), return_inverse=True)
        totals = np.bincount(inv, counts, len(values)).astype(np.int64)
        out, at = [], 0
        for p, v in zip(frame["p"], vals, strict=True):
            t = totals[inv[at:at + len(v)]]
            at += len(v)
            if (t > 1).any():
                out.append((p, pack(v[t > 1]), pack_counts(t[t > 1])))
        return pd.DataFrame(out, columns=["p", "vals", "counts"])

    def ordered(key: tuple, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        vals = np.concatenate([unpack(x) for x in answers["vals"]] or [np.zeros(1, np.uint64)])
        counts = np.concatenate([unpack_counts(x) for x in answers["counts"]] or [np.zeros(1, np.uint32)])
        order = np.argsort(vals)
        vals, counts = vals[order], counts[order]
        out = []
        for c, s in sets(frame):
            b, n = s >> _SHIFT, len(s)
            at = np.minimum(np.searchsorted(vals, b), len(vals) - 1)
            hit = (vals[at] == b) & (counts[at] > 1)
            open_ = prefix_length(n, percent) - int(n - hit.sum())  # one-class shingles come first
            if open_ > 0:
                s, k = s[hit], counts[at[hit]]
                s = s[np.lexsort((s, k))]
                out.append((c, n, s.astype("<u8").tobytes(), s[:open_].view(np.int64)))
            else:
                out.append((c, n, None, None))
        return pd.DataFrame(out, columns=["cls", "n", "shared", "prefix"])

    answers = (classes.groupBy("p").applyInPandas(sent, "r long, p long, vals binary, counts binary")
               .groupBy("r").applyInPandas(summed, "p long, vals binary, counts binary"))
    return classes.groupBy("p").cogroup(answers.groupBy("p")).applyInPandas(
        ordered, "cls long, n long, shared binary, prefix array<long>")


def clusters(found: DataFrame) -> DataFrame:
    """cls, cluster: classes that share a prefix shingle, directly or over others."""
    tokens = staged(found.select("cls", F.explode("prefix").alias("token")), "prefix-tokens")
    least = tokens.groupBy("token").agg(F.min("cls").alias("b"), F.count("*").alias("k")).where("k > 1")
    edges = tokens.join(least, "token").select(F.col("cls").alias("a"), "b").where("a <> b").distinct()
    return components(edges, "clusters").select(F.col("node").alias("cls"), F.col("root").alias("cluster"))


# ---- 5: one block

def trie_links(sets: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, members: np.ndarray | None = None,
               percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (i, j) that connect the labelled components of the sets as far as links can.

    The trie holds the ordered sets of ``members`` (default: all); the probes are all sets.  The
    sizes are those of the whole sets, of which ``sets`` has the shared part.
    """
    n = len(sets)
    labels = np.array(labels)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    own = np.repeat(np.arange(n), [len(s) for s in sets])
    _, local = np.unique(flat, return_inverse=True)
    post = own[np.argsort(local, kind="stable")]  # the probes of each token
    ptr = np.concatenate([[0], np.cumsum(np.bincount(local))]).astype(np.int64)
    cuts = np.cumsum([0, *(len(s) for s in sets)])
    seqs = [local[cuts[i]:cuts[i + 1]].astype(np.int64) for i in range(n)]
    lens = np.array([len(s) for s in seqs], np.int64)
    sizes = np.asarray(sizes, np.int64)
    among = range(n) if members is None else members
    order = np.array(sorted(among, key=lambda i: seqs[i].astype(">u4").tobytes()), np.int64)
    alone = members is None  # a self-join: each pair is met once, from the set that comes later in the trie
    place = np.full(n, n, np.int64)
    place[order] = np.arange(len(order))
    out: list[tuple[int, int]] = []
    todo = [(0, len(order), 0, np.zeros(n, np.int64), np.arange(n))] if len(order) else []
    while todo:
        lo, hi, depth, overlap, active = todo.pop()
        below = order[lo:hi]
        first, last = seqs[below[0]], seqs[below[-1]]
        stop = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:stop] != last[depth:stop])
        end = depth + int(differ[0]) if len(differ) else stop
        if alone:
            active = active[place[active] > lo]
        same = labels[below]
        if (same == same[0]).all():
            active = active[labels[active] != same[0]]
        least = int(sizes[below].min())
        rest = np.minimum(lens[below].max() - depth, lens[active] - overlap[active])
        active = active[(100 + percent) * (overlap[active] + rest) >= percent * (sizes[active] + least)]
        if not len(active):
            continue
        if end > depth:
            seg = first[depth:end]
            starts, counts = ptr[seg], ptr[seg + 1] - ptr[seg]
            at = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            overlap = overlap + np.bincount(post[at], minlength=n)
        mid = lo
        while mid < hi and lens[order[mid]] == end:  # sets that end here
            y = int(order[mid])
            mid += 1
            can = active[(100 + percent) * overlap[active] >= percent * (sizes[active] + sizes[y])]
            if alone:
                can = can[place[can] > place[y]]
            can = can[labels[can] != labels[y]]
            while len(can):
                x = int(can[0])
                out.append((x, y))
                labels[labels == labels[x]] = labels[y]
                can = can[labels[can] != labels[y]]
        if mid < hi:
            nxt = np.array([seqs[i][end] for i in order[mid:hi]])
            edges = [0, *(np.flatnonzero(np.diff(nxt)) + 1), hi - mid]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                todo.append((mid + a, mid + b, end, overlap, active))
    return out


def _joined(frame: pd.DataFrame, percent: int, probing: bool) -> pd.DataFrame:
    """The links of one group: its clusters one by one; rows with ``probe`` are no part of the trie."""
    out = []
    for _, f in frame.groupby("cluster", sort=False):
        f = f.drop_duplicates("cls") if not probing else f.sort_values("probe").drop_duplicates("cls")
        cls = f["cls"].to_numpy()
        _, labels = np.unique(f["label"].to_numpy(), return_inverse=True)
        sets = [np.frombuffer(x, "<u8") for x in f["shared"]]
        members = np.flatnonzero(~f["probe"].to_numpy(bool)) if probing else None
        out += [(cls[i], cls[j]) for i, j in trie_links(sets, f["n"].to_numpy(), labels, members, percent)]
    return pd.DataFrame(out, columns=["a", "b"])


# ---- 4: all blocks

def class_links(found: DataFrame, of: DataFrame, block: int = BLOCK, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between classes that make their components."""
    sizes = of.groupBy("cluster").agg(F.count("*").alias("size"))
    rows = (found.select("cls", "n", "shared").join(of, "cls").join(sizes, "cluster")
            .withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("long"))
            .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks"))))
    rows = staged(rows, "cluster-rows")
    packs = max(1, -(-rows.where("blocks = 1").count() // block))
    whole = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(packs)))
    schema = "a long, b long"
    within = (rows.withColumn("label", F.col("cls")).withColumn("probe", F.lit(False))
              .withColumn("pack", F.coalesce(whole, F.xxhash64("cluster", "block")))
              .groupBy("pack", "blocks", "block")
              .applyInPandas(lambda f: _joined(f, percent, False), schema))
    first = staged(within, "links-within")
    big = rows.where("blocks > 1")
    if not big.limit(1).count():
        return first

    def labelled(links_: DataFrame) -> DataFrame:
        """The rows of the large clusters with the component that they are in so far."""
        c = components(links_, "block-components")
        return big.join(c, big["cls"] == c["node"], "left").withColumn("label", F.coalesce("root", "cls")).drop("node", "root")

    now = labelled(first)
    heads = now.where("cls = label").withColumn("probe", F.lit(False))  # a component's root is its least class
    counts = heads.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("heads"))
    among = staged(heads.join(counts, "cluster").groupBy("cluster", F.pmod(F.xxhash64("cls", F.lit(1)), "heads").alias("h"))
                   .applyInPandas(lambda f: _joined(f, percent, False), schema), "links-heads")
    now = staged(labelled(first.union(among)), "cluster-labels")
    per = now.groupBy("cluster", "label").agg(F.count("*").alias("k"))
    largest = per.groupBy("cluster").agg(F.max(F.struct("k", "label")).alias("x"), F.sum("k").alias("all"))
    outside = largest.select("cluster", F.col("x.label").alias("main"), (F.col("all") - F.col("x.k")).alias("m"))
    now = (now.join(outside, "cluster").where("m > 0")
           .withColumn("chunks", F.ceil(F.col("m") / F.lit(block)).cast("long")))
    zero = F.lit(0).cast("long")
    members = now.withColumn("probe", F.lit(False)).withColumn("chunk", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    probes = (now.where("label <> main").withColumn("probe", F.lit(True))
              .withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(2)), F.col("chunks")))
              .withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1))))
    last = (members.unionByName(probes).groupBy("cluster", "block", "chunk")
            .applyInPandas(lambda f: _joined(f, percent, True), schema))
    return first.union(among).union(staged(last, "links-across"))


# ---- 6: documents

def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, cls, n_shingles, root (null: no words), component_id of every row."""
    sigs = staged(signatures(docs), "signatures")
    classes = staged(prefixes(sigs, size, percent), "prefixes")
    found = classes.where("prefix is not null")
    roots = components(class_links(found, clusters(found), block, percent), "links")
    named = (classes.select(F.col("cls").alias("__cls"), "n").join(roots, F.col("__cls") == F.col("node"), "left")
             .select("__cls", "n", F.coalesce("root", "__cls").alias("root")))
    rows = (sigs.select("doc_id", "cls").join(named, F.col("cls") == F.col("__cls"), "left")
            .select("doc_id", "cls", F.coalesce("n", F.lit(0).cast("long")).alias("n_shingles"), "root"))
    names = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return (rows.join(names.withColumnRenamed("root", "__root"), F.col("root") == F.col("__root"), "left")
            .select("doc_id", "cls", "n_shingles", "root", F.coalesce("least", "doc_id").alias("component_id")))


def with_class(docs: DataFrame) -> DataFrame:
    """All columns and ``__cls``, the class of the text."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            cls = pa.array([class_of(lowered(t)) for t in b.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, cls], names=[*b.schema.names, "__cls"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__cls", LongType())]))


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """All columns of one document a component (the least doc_id); wordless documents all stay."""
    rows = near_duplicates(docs, size, percent, block)
    kept = (rows.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "cls")).alias("x"))
            .select(F.col("x.doc_id").alias("__id"), F.col("x.cls").alias("__kept")))

    named = with_class(set_apart(docs, "doc_id", "text"))
    one = named.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__cls") == F.col("__kept")), "left_semi")
    out = one.dropDuplicates(["doc_id", "__cls"]).unionByName(named.where("__cls is null"))
    return out.select(*put_back(out, docs, "doc_id", "text"))
