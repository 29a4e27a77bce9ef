"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, with DataFrame operations only.

1. Targets. Sources weigh 1, 2, 3, 1, ... by code point; each may take at most ``MOST`` times its own size, and
   what it cannot take is shared anew by weight. Solved in closed form over one row per source.
2. Blocks. A source's documents are put in an order given by md5 and cut into at most ``BLOCKS`` blocks of about equal words.
   Each full pass over a source takes all its blocks; the last, partial pass takes the first blocks of a random permutation until
   their words reach the target. Of the block in which that happens it takes the documents whose middles lie before the
   target, so the words taken differ from the target by half a document (or half a set of equal rows) at most.
3. Tree. The drawn blocks of all sources are split in halves again and again until each output shard has its own. A split
   sends a random half of a node's blocks left, drawn without replacement, so that the numbers of blocks it takes of each
   source are multivariate hypergeometric. The draw takes the blocks with the smallest hashes, exactly half of them: hash
   ranges are counted, and only the range in which the cut lies is ranked.
4. The shards' blocks are disjoint, and a document goes to the shards that its block went to, once per repetition. Rows
   are then shuffled within a shard.

No source is gathered in one task: positions come from running sums in three levels (64 x 64 hash ranges a
source), the last of which is spread by source and range. The tree works on rows of blocks, spread by hash range. Only
the targets are solved in one task, over one row of numbers per source, as they depend on all sources.

Cases: a null text has size 0; documents without words are never taken; the null source is a source of its own and comes last; rows
equal in id, source and text share one position, so they are taken equally often, whatever their order; null ids
are ordinary ids; a text of any length is one document in one block; an empty table gives an empty table; other columns,
whatever their names, only pass through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.common import WORD
from lexloom.sources.scratch import materialize

MOST = 3  # a source's target and a document's repetitions, in times its size
BLOCKS = 1024  # of equal words, for each source
SHARDS = 8  # output shards, a power of two
SEED = 20_240_917


def source_key(source: str | Column = "source") -> Column:
    """The source as a non-null key."""
    c = F.col(source) if isinstance(source, str) else source
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c))


def row_key(id_col: str, text_col: str) -> Column:
    """Orders a source's documents; equal for equal rows only."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).cast("binary"))


def targets(sizes: DataFrame) -> DataFrame:
    """(sk, source, source_size) -> + target. One row per source."""
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    weighed = sizes.withColumn("w", (F.pmod(F.row_number().over(ordered) - 1, F.lit(3)) + 1).cast("long")).withColumn("most", F.col("source_size") * MOST)
    # by most/w, exactly: 6 is a multiple of every weight
    filling = Window.orderBy((F.col("most") * 6 / F.col("w")).cast("long"), F.col("source").isNull(), "source")
    before, all_rows = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = weighed.select(
        "*",
        F.sum("source_size").over(all_rows).alias("words"),
        F.sum("w").over(all_rows).alias("weights"),
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("most_before"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"),
    ).withColumn("full", F.col("most") * (F.col("weights") - F.col("w_before")) < F.col("w") * (F.col("words") - F.col("most_before")))
    rest = level.select(
        "*",
        (F.col("words") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(all_rows), F.lit(0))).alias("words_left"),
        (F.col("weights") - F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(all_rows), F.lit(0))).alias("w_left"),
    )
    target = F.when(F.col("full"), F.col("most").cast("double")).when(F.col("w_left") == 0, F.lit(0.0)).otherwise((F.col("w") * F.col("words_left")) / F.col("w_left"))
    return rest.withColumn("target", target).select("sk", "source", "source_size", "target")


def drawn_blocks(blocks: DataFrame, facts: DataFrame, seed: int = SEED) -> DataFrame:
    """(sk, block, words) and (sk, source_size, target) -> (sk, epoch, block, room).

    All blocks once per full pass, and in the last pass a random part of them. ``room`` is null for whole blocks; else
    it is how many of the block's words are still wanted.
    """
    passes = facts.where("source_size > 0").select("sk", F.floor(F.col("target") / F.col("source_size")).cast("int").alias("full"), "source_size", "target")
    of = blocks.select("sk", "block", "words").join(passes.select("sk", "full", (F.col("target") - F.col("full") * F.col("source_size")).alias("wanted")), "sk")
    whole = of.where("full > 0").select("sk", F.explode(F.expr("sequence(0, full - 1)")).alias("epoch"), "block", F.lit(None).cast("double").alias("room"))
    permuted = Window.partitionBy("sk").orderBy(_draw(seed, "pass", "sk", "epoch", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    part = of.withColumnRenamed("full", "epoch").withColumn("before", F.coalesce(F.sum("words").over(permuted), F.lit(0))).where("before < wanted")
    return whole.unionByName(part.select("sk", "epoch", "block", F.when(F.col("before") + F.col("words") > F.col("wanted"), F.col("wanted") - F.col("before")).alias("room")))


def _draw(seed: int, *parts: str | Column) -> Column:
    """A hash in hexadecimal that the given parts alone decide."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.lit(p) if p == "pass" else F.col(p).cast("string") if isinstance(p, str) else p for p in parts)).cast("binary"))


def splitting_tree(drawn: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(sk, epoch, block, room) -> the same with the shard that gets it; nodes are runs of shards [lo, hi)."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards is a power of two")
    node = materialize(drawn, "mixing-drawn").withColumn("lo", F.lit(0)).withColumn("width", F.lit(shards))
    while shards > 1:
        hashed = node.withColumn("h", _draw(seed, "lo", "width", "sk", "epoch", "block")).withColumn("range", F.substring("h", 1, 3))
        # at most 4096 ranges a node
        counts = hashed.groupBy("lo", "range").agg(F.count("*").alias("n"))
        by_range = Window.partitionBy("lo").orderBy("range")
        cuts = counts.select("lo", "range", F.coalesce(F.sum("n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.expr("sum(n) over (partition by lo) div 2").alias("half"))
        within = Window.partitionBy("lo", "range").orderBy("h", "sk", "epoch", "block")
        placed = hashed.join(cuts, ["lo", "range"]).withColumn("at", F.col("before") + F.row_number().over(within))
        shards //= 2
        node = placed.select("sk", "epoch", "block", "room", F.when(F.col("at") <= F.col("half"), F.col("lo")).otherwise(F.col("lo") + shards).cast("int").alias("lo"), F.lit(shards).alias("width"))
    return node.select("sk", "epoch", "block", "room", F.col("lo").alias("shard"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, sk, key, size, source_size, target, times (it is taken), shards (one per repetition)."""
    key = F.col("key")
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        source_key(F.col(source_col).cast("string")).alias("sk"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_key(id_col, text_col).alias("key"),
    )
    base = materialize(base, "mixing").withColumn("b1", F.conv(F.substring(key, 1, 2), 16, 10).cast("int") % 64).withColumn("b2", F.conv(F.substring(key, 3, 2), 16, 10).cast("int") % 64)
    level3 = base.groupBy("sk", "b1", "b2").agg(F.sum("size").alias("words"))
    level2 = base.groupBy("sk", "b1").agg(F.sum("size").alias("words"))
    facts = materialize(targets(base.groupBy("sk").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))).drop("source"), "mixing-targets")

    def running(*by: str):
        w = Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("words").over(w), F.lit(0))

    above2 = level2.withColumn("before1", running("sk", "b1")).join(facts, "sk").drop("words")
    above3 = level3.withColumn("before2", running("sk", "b1", "b2")).join(above2, ["sk", "b1"]).drop("words")
    in_range = Window.partitionBy("sk", "b1", "b2").orderBy("key")
    through = F.sum("size").over(in_range.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    peers = F.sum("size").over(in_range.rangeBetween(Window.currentRow, Window.currentRow))
    placed = base.withColumn("through", through).withColumn("peers", peers).join(above3, ["sk", "b1", "b2"])
    # twice the middle of the row's place among its source's words
    middle = (F.col("before1") + F.col("before2") + F.col("through")) * 2 - F.col("peers")
    block = F.when(F.col("size") > 0, F.least(F.expr(f"(middle * {BLOCKS}) div (2 * source_size)"), F.lit(BLOCKS - 1))).cast("int")
    located = materialize(placed.withColumn("middle", middle).withColumn("block", block).select("doc_id", "sk", "key", "size", "source_size", "target", "block", "middle", "peers"), "mixing-located")
    blocks = located.where("block is not null").groupBy("sk", "block").agg(F.sum("size").alias("words"), F.min(F.col("middle") - F.col("peers")).alias("begin"))
    dealt = splitting_tree(drawn_blocks(blocks, facts, seed), shards, seed).groupBy("sk", "block").agg(F.array_sort(F.collect_list(F.struct("epoch", "shard", "room"))).alias("dealt"))  # at most one entry per repetition
    found = located.join(blocks.select("sk", "block", "begin").join(dealt, ["sk", "block"]), ["sk", "block"], "left")
    taken = F.filter("dealt", lambda d: d["room"].isNull() | (F.col("middle") - F.col("begin") <= 2 * d["room"]))["shard"]
    return found.withColumn("shards", F.coalesce(taken, F.expr("cast(array() as array<int>)"))).select("doc_id", "sk", "key", "size", "source_size", "target", F.size("shards").alias("times"), "shards")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixed rows with all their columns, plus ``mix_shard`` and ``mix_order`` (a random place in the shard)."""
    plan = plan_mix(docs, id_col, text_col, source_col, shards, seed).where("times > 0").groupBy("sk", "key").agg(F.first("shards").alias("shards"))
    # numbered names, so that no column of docs can clash with ours; columns called like the two new ones are replaced
    number = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.toDF(*number.values()).withColumns({"sk": source_key(F.col(number[source_col]).cast("string")), "key": row_key(number[id_col], number[text_col])})
    drawn = keyed.join(plan, ["sk", "key"]).select(*number.values(), "key", F.posexplode("shards").alias("epoch", "shard"))
    kept = [F.col(n).alias(c) for c, n in number.items() if c not in ("mix_shard", "mix_order")]
    return drawn.select(*kept, F.col("shard").alias("mix_shard"), F.xxhash64(F.lit(seed), "key", "epoch").alias("mix_order"))


def shuffled(mixed: DataFrame) -> DataFrame:
    """Rows dealt at random, in random order within their shards: what a writer of shards would store.

    Every row is dealt by itself, into as many tasks as the session has shuffle partitions.
    """
    return mixed.repartition("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")


def op7_mixing(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    plan = plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), F.array_join("shards", ",").alias("shards"))


ORACLE = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM base GROUP BY source),
weighed AS (SELECT source, s, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS w, 3 * s AS most FROM sizes),
filled AS (
  SELECT *, CAST(sum(s) OVER () AS BIGINT) AS words, CAST(sum(w) OVER () AS BIGINT) AS weights,
         CAST(coalesce(sum(most) OVER o, 0) AS BIGINT) AS most_before, CAST(coalesce(sum(w) OVER o, 0) AS BIGINT) AS w_before
  FROM weighed
  WINDOW o AS (ORDER BY most * 6 // w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, most * (weights - w_before) < w * (words - most_before) AS capped FROM filled),
rest AS (
  SELECT *, words - CAST(coalesce(sum(CASE WHEN capped THEN most END) OVER (), 0) AS BIGINT) AS words_left,
         weights - CAST(coalesce(sum(CASE WHEN capped THEN w END) OVER (), 0) AS BIGINT) AS w_left
  FROM flagged),
aimed AS (
  SELECT source, s, CASE WHEN capped THEN CAST(most AS DOUBLE) WHEN w_left = 0 THEN 0.0 ELSE CAST(w * words_left AS DOUBLE) / CAST(w_left AS DOUBLE) END AS target FROM rest),
sources AS (SELECT *, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS sk, CASE WHEN s = 0 THEN 0 ELSE CAST(floor(target / s) AS BIGINT) END AS whole FROM aimed),
placed AS (
  SELECT b.doc_id, b.size, q.sk, q.s, q.target,
         CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.b1, b.b2, b.key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS through,
         CAST(sum(b.size) OVER (PARTITION BY b.source, b.key) AS BIGINT) AS peers
  FROM (SELECT *, CAST(concat('0x', substr(key, 1, 2)) AS INT) % 64 AS b1, CAST(concat('0x', substr(key, 3, 2)) AS INT) % 64 AS b2 FROM base) b
  JOIN sources q ON b.source IS NOT DISTINCT FROM q.source),
blocked AS (SELECT *, 2 * through - peers AS middle, CASE WHEN size > 0 THEN least(((2 * through - peers) * 1024) // (2 * s), 1023) END AS block FROM placed),
blocks AS (SELECT sk, block, CAST(sum(size) AS BIGINT) AS words, min(middle - peers) AS begin FROM blocked WHERE block IS NOT NULL GROUP BY sk, block),
part AS (
  SELECT *, CAST(coalesce(sum(words) OVER (PARTITION BY sk ORDER BY md5(concat_ws('|', '20240917', 'pass', sk, whole, block)), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM (SELECT b.*, q.whole, q.target - q.whole * q.s AS wanted FROM blocks b JOIN sources q ON b.sk = q.sk)),
drawn AS (
  SELECT sk, unnest(range(0, whole)) AS epoch, block, NULL AS room FROM part
  UNION ALL SELECT sk, whole, block, CASE WHEN before + words > wanted THEN wanted - before END FROM part WHERE before < wanted),
split1 AS (SELECT sk, epoch, block, room, CASE WHEN nth <= n // 2 THEN 0 ELSE 4 END AS lo FROM (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '20240917', 0, 8, sk, epoch, block)), sk, epoch, block) AS nth, count(*) OVER () AS n FROM drawn)),
split2 AS (SELECT sk, epoch, block, room, CASE WHEN nth <= n // 2 THEN lo ELSE lo + 2 END AS lo FROM (
  SELECT *, row_number() OVER (PARTITION BY lo ORDER BY md5(concat_ws('|', '20240917', lo, 4, sk, epoch, block)), sk, epoch, block) AS nth, count(*) OVER (PARTITION BY lo) AS n FROM split1)),
split3 AS (SELECT sk, epoch, block, room, CASE WHEN nth <= n // 2 THEN lo ELSE lo + 1 END AS shard FROM (
  SELECT *, row_number() OVER (PARTITION BY lo ORDER BY md5(concat_ws('|', '20240917', lo, 2, sk, epoch, block)), sk, epoch, block) AS nth, count(*) OVER (PARTITION BY lo) AS n FROM split2)),
dealt AS (
  SELECT b.doc_id, b.sk, b.block, b.middle, string_agg(CAST(shard AS VARCHAR), ',' ORDER BY epoch) AS shards, count(*) AS times
  FROM (SELECT DISTINCT doc_id, sk, block, middle FROM blocked) b JOIN blocks k ON b.sk = k.sk AND b.block = k.block JOIN split3 d ON b.sk = d.sk AND b.block = d.block
  WHERE room IS NULL OR b.middle - k.begin <= 2 * room GROUP BY b.doc_id, b.sk, b.block, b.middle)
SELECT b.doc_id, CAST(b.size AS BIGINT) AS size, b.s AS source_size, b.target, CAST(b.size * coalesce(d.times, 0) AS BIGINT) AS taken, coalesce(d.shards, '') AS shards
FROM blocked b LEFT JOIN dealt d ON b.doc_id IS NOT DISTINCT FROM d.doc_id AND b.sk = d.sk AND b.block = d.block AND b.middle = d.middle
"""
