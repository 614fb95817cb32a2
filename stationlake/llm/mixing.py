"""Mixing sources to target weights: a splitting tree over exact block quotas (native).

1. Sources in code point order (null last) weigh 1, 2, 3, repeating, and share all words by
   weight; a target stops at ``MAX_EPOCHS`` times its source's words and the excess is shared
   anew by weight until no target is above.
2. A source's documents are dealt by a hash into blocks of about ``block_docs`` documents.  A
   source draws its blocks ``floor(target / words)`` times whole; what is left is drawn from
   its blocks in a permuted order, the last of them only in part: going through its documents in hash
   order, each one that still fits, and then the one of the others whose size comes nearest to what is
   missing, if it brings the sum nearer.  So no document is drawn more than ``MAX_EPOCHS`` times.
3. The drawn blocks are dealt to output shards by a binary tree: each node holds how many
   blocks of each source it has to place, and splits these quotas between the shards of its
   left and right half by drawing without replacement (selection sampling over the node's
   blocks), which is a multivariate hypergeometric draw with exact totals on both sides.  At a
   leaf, a source's quota takes the next blocks of that source's permuted sequence, so shards
   are disjoint.  ``mix`` then orders each shard's documents by a hash.

Everything is DataFrame work.  Documents are never windowed by source: they are aggregated to
(source, block) first, a window runs over the blocks of one source, and over the documents of
one block only for the one block a source draws in part.  The tree's rows hold one number a
source.  Hashes are taken of ids and sizes, so reruns agree.  Rows that repeat both are told apart by source, text and,
if these are equal too, by a number (part by part, with the counts of the parts before).

Edge cases: a null or empty text has size 0 and takes 0 words; null is a source of its own;
repeated rows are drawn one by one; a table without words has targets 0; an empty
table gives an empty result; other columns of the table are not read (``mix`` returns them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import WORD, put_back, set_apart, staged

MAX_EPOCHS = 3
BLOCK_DOCS = 512
SHARD_WORDS = 1_000_000
SEED = 20240


def hashed(*parts: str | Column) -> Column:
    """A 60-bit number from the md5 of the parts, the same in any SQL engine."""
    text = F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null"))
                              for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def with_size(seed: int = SEED) -> list[Column]:
    """The size of documents, a number of id and size, and one that only rows of equal id, source and text share."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return [size.alias("__size"), hashed(f"doc:{seed}", F.col("doc_id"), size).alias("__base"),
            hashed(f"row:{seed}", F.col("doc_id"), F.concat(F.lit("="), "source"), text).alias("__same")]


def keyed(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with ``__key`` instead of ``__base`` and ``__same``; the ``repeated`` get one each."""
    if not repeated.limit(1).count():
        return rows.withColumnRenamed("__base", "__key").drop("__same")
    alone = rows.join(repeated, "__base", "left_anti").withColumnRenamed("__base", "__key").drop("__same")
    again = staged(rows.join(repeated, "__base", "left_semi").drop("__base").withColumn("__part", F.spark_partition_id()), "mix-again")
    so_far = F.sum("__rows").over(Window.partitionBy("__same").orderBy("__part"))
    before = (again.groupBy("__same", "__part").agg(F.count("*").alias("__rows"))
              .select("__same", "__part", (so_far - F.col("__rows")).alias("__before")))
    copy = F.col("__before") + F.row_number().over(Window.partitionBy("__same", "__part").orderBy(F.lit(0))) - 1
    numbered = (again.join(before, ["__same", "__part"]).withColumn("__copy", copy)
                .withColumn("__key", hashed("copy", F.col("__same"), F.col("__copy"))))
    return alone.unionByName(numbered.drop("__same", "__part", "__before", "__copy"))


def source_targets(sized: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """source, n_docs, source_size, rank (from 0), weight, target, n_blocks of every source."""
    per = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("__size").alias("source_size"))
    # the rank: rows are ranged by source, counted by range, and numbered inside their range
    by = F.col("source").asc_nulls_last()
    ranged = staged(per.repartitionByRange(by).withColumn("__part", F.spark_partition_id()), "mix-sources")
    before = (ranged.groupBy("__part").agg(F.count("*").alias("__n"))
              .select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before")))
    per = (ranged.join(before, "__part")
           .withColumn("rank", F.col("__before") + F.row_number().over(Window.partitionBy("__part").orderBy(by)) - 1)
           .withColumn("weight", (F.col("rank") % 3 + 1).cast("long"))
           .withColumn("__cap", F.col("source_size") * MAX_EPOCHS)
           .withColumn("n_blocks", F.ceil(F.col("n_docs") / F.lit(block_docs)).cast("long"))
           .drop("__part", "__before"))
    per = staged(per, "mix-ranks")
    total = per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full = 0.0, -1
    while total:  # ends: the level only rises, so the set of full sources only grows
        is_full = F.col("__cap") < F.lit(level) * F.col("weight")
        r = per.agg(F.sum(F.when(is_full, F.col("__cap")).otherwise(0)).alias("cap"),
                    F.sum(F.when(is_full, 0).otherwise(F.col("weight"))).alias("w"),
                    F.sum(is_full.cast("long")).alias("n")).first()
        if r.n == full or not r.w:
            break
        level, full = (total - r.cap) / r.w, r.n
    return per.select("source", "n_docs", "source_size", "rank", "weight", "n_blocks",
                      F.least(F.col("__cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def block_draws(sized: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """rank, block, epoch, seq (from 0 in the source) and words of each drawn block; a block that is
    drawn in part has ``keys``, those of the documents that are drawn (at most a block's)."""
    in_block = (sized.join(targets.select("source", "rank", "n_blocks"), sized["source"].eqNullSafe(targets["source"]))
                .select("rank", (F.col("__key") % F.col("n_blocks")).alias("block"), "__key", "__size"))
    blocks = in_block.groupBy("rank", "block").agg(F.sum("__size").alias("words"))
    t = targets.select("rank", "target", "source_size",
                       F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("int").alias("epochs"))
    t = t.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    perm = hashed(f"block:{seed}", F.col("rank"), F.col("block"))
    cum = F.sum("words").over(Window.partitionBy("rank").orderBy("__perm", "block"))
    blocks = staged(blocks.join(t, "rank").withColumn("__perm", perm).withColumn("__end", cum)
                    .withColumn("__left", F.col("rest") - (F.col("__end") - F.col("words"))), "mix-blocks")
    times = F.col("epochs") + F.when(F.col("__end") <= F.col("rest"), 1).otherwise(0)
    whole = (blocks.where(times > 0).select("rank", "block", "words", F.explode(F.sequence(F.lit(0), times - 1))
             .alias("epoch")).withColumn("keys", F.lit(None).cast("array<long>")))
    cut = blocks.where("words > 0 and __left > 0 and __left < words")
    units = (in_block.join(cut.select("rank", "block", "epochs", "__left"), ["rank", "block"])
             .groupBy("rank", "block", "epochs", "__left", "__key").agg(F.sum("__size").alias("u")))

    def fill(acc, x):
        """Take one more document if it fits."""
        return F.when(x["u"] <= acc["room"], F.struct(
            (acc["room"] - x["u"]).alias("room"), F.concat(acc["keys"], F.array(x["__key"])).alias("keys"),
            (acc["words"] + x["u"]).alias("words"))).otherwise(acc)

    start = F.struct(F.col("__left").alias("room"), F.array().cast("array<long>").alias("keys"),
                     F.lit(0).cast("long").alias("words"))
    def with_nearest(f):
        """The filled draw and the document that brings it nearest, if one does."""
        others = F.filter("units", lambda x: (F.abs(x["u"] - f["room"]) < f["room"]) & ~F.array_contains(f["keys"], x["__key"]))
        plus = F.array_min(F.transform(others, lambda x: F.struct(
            F.abs(x["u"] - f["room"]).alias("off"), x["__key"].alias("key"), x["u"].alias("u"))))
        return F.struct(f["keys"].alias("keys"), f["words"].alias("words"), plus.alias("plus"))

    # (the fold is bound to a lambda's variable, so it is computed once and not for every use)
    part = (units.groupBy("rank", "block", "epochs", "__left")
            .agg(F.array_sort(F.collect_list(F.struct("__key", "u"))).alias("units"))
            .select("rank", "block", "epochs", F.explode(F.transform(
                F.array(F.aggregate("units", start, fill)), with_nearest)).alias("f"))
            .select("rank", "block", (F.col("f.words") + F.coalesce("f.plus.u", F.lit(0))).alias("words"),
                    F.col("epochs").alias("epoch"),
                    F.when(F.col("f.plus").isNull(), F.col("f.keys")).otherwise(
                        F.concat("f.keys", F.array("f.plus.key"))).alias("keys")).where(F.size("keys") > 0))
    order = Window.partitionBy("rank").orderBy("epoch", hashed(f"order:{seed}", *map(F.col, ("rank", "epoch", "block"))))
    return whole.unionByName(part).withColumn("seq", F.row_number().over(order) - 1)


def _half(side: str):
    """Of a split quota, the part of one side."""
    return lambda x: F.struct(x["rank"].alias("rank"), x[side].alias("n"))


def split_quotas(draws: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """rank, shard, first, n: the quota of each source in each shard, and where it starts in the source's sequence."""
    nodes = (draws.groupBy("rank").agg(F.count("*").cast("long").alias("n"))
             .groupBy().agg(F.array_sort(F.collect_list(F.struct("rank", "n"))).alias("q"))
             .select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "q"))
    level = 0
    while 1 << level < shards:
        def unit(node_lo, rank, i, level=level):
            """A number in [0, 1) for one draw."""
            h = F.xxhash64(F.lit(seed), F.lit(level), node_lo, rank, i)
            return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))

        def of_source(acc, x):
            """Draw x.n blocks one by one: each goes left with the chance left slots / blocks that remain."""
            drawn = F.aggregate(
                F.sequence(F.lit(1).cast("long"), x["n"]),
                F.struct(F.lit(0).cast("long").alias("got"), acc["slots"].alias("slots"), acc["all"].alias("all")),
                lambda a, i: F.when(unit(acc["lo"], x["rank"], i) * a["all"] < a["slots"],
                                    F.struct((a["got"] + 1).alias("got"), (a["slots"] - 1).alias("slots"),
                                             (a["all"] - 1).alias("all")))
                .otherwise(F.struct(a["got"].alias("got"), a["slots"].alias("slots"), (a["all"] - 1).alias("all"))))
            return F.transform(F.array(drawn), lambda d: F.struct(
                d["slots"].alias("slots"), d["all"].alias("all"), acc["lo"].alias("lo"),
                F.concat(acc["out"], F.array(F.struct(x["rank"].alias("rank"), d["got"].alias("left"),
                                                      (x["n"] - d["got"]).alias("right")))).alias("out")))[0]

        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["n"])
        mid = F.floor((F.col("lo") + F.col("hi") + 1) / 2)
        nodes = (nodes.repartition("lo").withColumn("mid", mid).withColumn("all", total)
                 .withColumn("slots", F.round(F.col("all") * (F.col("mid") - F.col("lo"))
                                              / (F.col("hi") - F.col("lo"))).cast("long"))
                 .withColumn("s", F.aggregate("q", F.struct(
                     F.col("slots"), F.col("all"), F.col("lo"),
                     F.array().cast("array<struct<rank:bigint,left:bigint,right:bigint>>").alias("out")), of_source)))
        halves = []
        for lo, hi, side in (("lo", "mid", "left"), ("mid", "hi", "right")):
            q = F.filter(F.transform("s.out", _half(side)), lambda x: x["n"] > 0)
            halves.append(F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"), q.alias("q")))
        one = F.col("hi") - F.col("lo") <= 1
        nodes = nodes.select(F.explode(F.when(one, F.array(F.struct("lo", "hi", "q"))).otherwise(F.array(*halves)))
                             .alias("x")).select("x.*")
        level += 1
    leaves = nodes.select(F.col("lo").alias("shard"), F.explode("q").alias("x")).select("shard", "x.rank", "x.n")
    before = F.sum("n").over(Window.partitionBy("rank").orderBy("shard")) - F.col("n")
    return leaves.withColumn("first", before)


def draw(docs: DataFrame, block_docs: int = BLOCK_DOCS, shard_words: int = SHARD_WORDS,
         seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The sized documents, the sources with their targets, every drawn block with its shard, and the repeated rows."""
    sized = staged(docs.select("doc_id", "source", *with_size(seed)), "mix-sizes")
    repeated = staged(sized.groupBy("__base").agg(F.count("*").alias("n")).where("n > 1").select("__base"), "mix-repeats")
    sized = keyed(sized, repeated)
    targets = staged(source_targets(sized, block_docs), "mix-targets")
    draws = staged(block_draws(sized, targets, seed), "mix-draws")
    words = draws.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    quotas = split_quotas(draws, max(1, -(-words // shard_words)), seed)
    places = quotas.select("rank", "shard", F.explode(
        F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("seq"))
    return sized, targets, staged(draws.join(places, ["rank", "seq"]), "mix-places"), repeated


def mix(docs: DataFrame, block_docs: int = BLOCK_DOCS, shard_words: int = SHARD_WORDS, seed: int = SEED,
        shard: str | None = "__shard") -> DataFrame:
    """All columns of the drawn documents and, under the name ``shard`` (None: left out), the number of their shard: rows
    repeat as often as they are drawn."""
    if shard in docs.columns:
        raise ValueError(f"the documents have a column {shard}: name another for the shard, or none")
    _, targets, draws, repeated = draw(docs, block_docs, shard_words, seed)
    t = targets.select(F.col("source").alias("__source"), F.col("rank").alias("__rank"), F.col("n_blocks").alias("__n"))
    d = draws.select(F.col("rank").alias("__rank"), F.col("block").alias("__block"), F.col("keys").alias("__keys"),
                     F.col("shard").alias("__shard"), F.col("epoch").alias("__epoch"))
    used = ("doc_id", "source", "text")
    own = set_apart(docs, *used)
    out = (keyed(own.select("*", *with_size(seed)), repeated).join(t, F.col("source").eqNullSafe(F.col("__source")))
           .withColumn("__block", F.col("__key") % F.col("__n")).join(d, ["__rank", "__block"])
           .where("__keys is null or array_contains(__keys, __key)"))
    local = hashed(f"local:{seed}", F.col("__shard"), F.col("__epoch"), F.col("__key"))
    out = out.withColumn("__local", local).repartition("__shard").sortWithinPartitions("__shard", "__local", "doc_id")
    return out.select(*put_back(out, docs, *used), *([F.col("__shard").alias(shard)] if shard else []))


def taken(docs: DataFrame, block_docs: int = BLOCK_DOCS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards (where its draws lie, ascending) of every document."""
    sized, targets, draws, _ = draw(docs, block_docs, shard_words, seed)
    # a block is drawn at most MAX_EPOCHS times, at most once of them in part
    part = F.when(F.col("keys").isNotNull(), F.col("shard"))
    per = draws.groupBy("rank", "block").agg(
        F.collect_list(F.when(F.col("keys").isNull(), F.col("shard"))).alias("whole"), F.first("keys", True).alias("keys"),
        F.first(part, True).alias("part"))
    t = targets.withColumnRenamed("source", "__source")
    return (sized.join(t, F.col("source").eqNullSafe(F.col("__source")))
            .withColumn("block", F.col("__key") % F.col("n_blocks")).join(per, ["rank", "block"], "left")
            .withColumn("shards", F.coalesce("whole", F.array().cast("array<long>")))
            .withColumn("shards", F.array_sort(F.when(F.array_contains("keys", F.col("__key")), F.array_append("shards", F.col("part")))
                                               .otherwise(F.col("shards"))))
            .select("doc_id", F.col("__size").alias("size"), "source_size", "target",
                    (F.col("__size") * F.size("shards")).alias("taken"), "shards"))


def oracle(block_docs: int = BLOCK_DOCS, seed: int = SEED) -> str:
    """DuckDB SQL of the query: the level by sorting sources, the draws by window sums."""
    h = lambda *p: f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(p)})), 1, 15) AS BIGINT)"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
      md5(coalesce(text, '')) AS digest FROM documents),
i AS (SELECT *, {h(f"'doc:{seed}'", "coalesce(doc_id::VARCHAR, 'null')", "size::VARCHAR")} AS base,
      {h(f"'row:{seed}'", "coalesce(doc_id::VARCHAR, 'null')", "coalesce('=' || source, 'null')", "digest")} AS same FROM d),
n AS (SELECT *, count(*) OVER (PARTITION BY base) AS alike, row_number() OVER (PARTITION BY same) - 1 AS copy FROM i),
k AS (SELECT *, CASE WHEN alike = 1 THEN base ELSE {h("'copy'", "same::VARCHAR", "copy::VARCHAR")} END AS key FROM n),
s AS (SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, sum(source_size) OVER ()::BIGINT AS total,
      ceil(n_docs / {block_docs})::BIGINT AS n_blocks, {MAX_EPOCHS} * source_size AS cap FROM s),
w AS (SELECT *, rank % 3 + 1 AS weight FROM r),
c AS (SELECT *, (total - coalesce(sum(cap) OVER o, 0)::BIGINT) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::BIGINT AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT coalesce(max(level), 0) AS level FROM c),
t AS (SELECT w.*, least(cap::DOUBLE, l.level * weight) AS target FROM w, l),
e AS (SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS epochs,
      target - floor(target / greatest(source_size, 1)) * source_size AS rest FROM t),
b AS (SELECT k.doc_id, k.size, k.key, e.rank, e.source_size, e.target, e.epochs, e.rest, k.key % e.n_blocks AS block
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
g AS (SELECT rank, block, rest, sum(size)::BIGINT AS words, {h(f"'block:{seed}'", "rank::VARCHAR", "block::VARCHAR")} AS perm
      FROM b GROUP BY ALL),
m AS (SELECT *, sum(words) OVER (PARTITION BY rank ORDER BY perm, block) AS upto FROM g),
u AS (SELECT rank, block, key, sum(size)::BIGINT AS u FROM b GROUP BY ALL),
x AS (SELECT u.*, m.rest - (m.upto - m.words) AS room, row_number() OVER (PARTITION BY rank, block ORDER BY key) AS i
      FROM u JOIN m USING (rank, block) WHERE m.upto > m.rest AND m.rest - (m.upto - m.words) > 0),
p AS (SELECT rank, block, 0::BIGINT AS i, any_value(room) AS room, NULL::BIGINT AS key, 0::BIGINT AS u, false AS fits
      FROM x GROUP BY rank, block
      UNION ALL SELECT x.rank, x.block, x.i, CASE WHEN x.u <= p.room THEN p.room - x.u ELSE p.room END, x.key, x.u, x.u <= p.room
      FROM p JOIN x ON p.rank = x.rank AND p.block = x.block AND x.i = p.i + 1),
y AS (SELECT *, min(room) OVER (PARTITION BY rank, block) AS missing FROM p),
z AS (SELECT *, row_number() OVER (PARTITION BY rank, block ORDER BY fits, abs(u - missing), key) AS near FROM y WHERE i > 0),
v AS (SELECT rank, block, key, fits OR (near = 1 AND abs(u - missing) < missing) AS drawn FROM z)
SELECT b.doc_id, b.size, b.source_size, b.target, (b.size * (b.epochs + CASE WHEN m.upto <= b.rest OR v.drawn THEN 1 ELSE 0 END))::BIGINT AS taken
FROM b JOIN m USING (rank, block) LEFT JOIN v USING (rank, block, key)"""
