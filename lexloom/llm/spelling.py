"""Spelling variants: words at distance one, found by Levenshtein automata over broadcast trie shards.

1. Words. Runs of letters are extracted, changed by the rule of ``misspelt``, and counted.
2. Shards. The vocabulary is sorted over all tasks and cut into shards of ``SHARD_BYTES`` of words, whatever the number of
   partitions. Each shard becomes a compact (path-compressed) trie of flat arrays, which keeps the words' counts.
3. Search. Groups of ``SHARDS_AT_ONCE`` tries are broadcast one after another; their size is bounded by the two constants,
   not by the vocabulary. Every word's distance-one automaton is intersected with every trie depth-first: along the word's own path,
   each node tries the deletion, the replacements and the insertions that its children allow, and follows the rest of the word.
4. Reduction. A word sends one row a group: how many neighbours it met and the best of them. Rows are reduced by word.
5. Roots. A form occurs at least ``FACTOR`` times as often as its word, so chains are short: as many rounds of pointer
   jumping as the largest count allows reach every end.

Cases: a null text has no words; a null id counts as an empty one in the rule; texts and words of any length are taken whole;
equal rows count as often as they stand; neighbours of equal counts: the smallest in code-point order is the best; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, rows_of
from lexloom.llm.wordblocks import pack, unpack
from lexloom.session import ship
from lexloom.sources.scratch import discard_at_exit, materialize, scratch_path

LEAST_LENGTH = 7
LEAST_COUNT = 2
FACTOR = 10
EVERY = 31
SHARD_BYTES = 2 << 20  # of words
SHARDS_AT_ONCE = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = rf"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run, or for one in ``EVERY`` hashes of id and run the run without a code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % EVERY == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): every word of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUNS), F.lit(0))).alias("run"))
    words = runs.select(misspelt(F.col("id"), F.col("run")).alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Trie:
    """Words with counts as a path-compressed trie in flat arrays.

    Nodes are numbered breadth-first, so that a node's children are neighbours: ``first[node]`` is the first of them and
    ``first[node + 1]`` the end. ``labels[cuts[node]:cuts[node + 1]]`` leads into a node, ``heads[node]`` is its first
    byte, and ``counts[node]`` is the count of the word that ends there, or 0. A word's letters are its Latin-1 bytes.
    """

    def __init__(self, first: array, cuts: array, heads: bytes, labels: bytes, counts: array):
        self.first, self.cuts, self.heads, self.labels, self.counts = first, cuts, heads, labels, counts

    @classmethod
    def of(cls, words: list[bytes], counts: list[int]) -> Trie:
        """From sorted distinct words."""
        first, labels, kept = array("q"), [b""], array("q")
        nodes = [(0, len(words), 0)]
        for lo, hi, depth in nodes:  # grows as nodes are met
            ends = lo < hi and len(words[lo]) == depth
            kept.append(counts[lo] if ends else 0)
            lo += ends
            first.append(len(nodes))
            while lo < hi:
                end = bisect_right(words, words[lo][depth], lo, hi, key=lambda w: w[depth])
                a, b = words[lo], words[end - 1]
                stop = len(a) if end - lo == 1 else shared_prefix(a, b, depth)
                labels.append(a[depth:stop])
                nodes.append((lo, end, stop))
                lo = end
        first.append(len(nodes))
        cuts = array("q", [0])
        cuts.extend(np.cumsum([len(x) for x in labels]).tolist())
        return cls(first, cuts, b"\0" + b"".join(x[:1] for x in labels[1:]), b"".join(labels), kept)

    def packed(self) -> bytes:
        return pack(*(np.frombuffer(x, np.int64) for x in (self.first, self.cuts, self.counts)), np.frombuffer(self.heads, np.uint8), np.frombuffer(self.labels, np.uint8))

    @classmethod
    def unpacked(cls, blob: bytes) -> Trie:
        first, cuts, counts, heads, labels = unpack(blob)
        return cls(array("q", first.tobytes()), array("q", cuts.tobytes()), heads.tobytes(), labels.tobytes(), array("q", counts.tobytes()))

    def _rest(self, node: int, at: int, word: bytes, j: int) -> int:
        """The count of the word that ``word[j:]`` completes from place ``at`` of a node's label on, or 0."""
        first, cuts, heads, labels, n = self.first, self.cuts, self.heads, self.labels, len(word)
        while True:
            start, stop = cuts[node] + at, cuts[node + 1]
            if stop - start == 1:
                if j >= n or labels[start] != word[j]:
                    return 0
                j += 1
            elif stop > start:
                if not word.startswith(labels[start:stop], j):
                    return 0
                j += stop - start
            if j == n:
                return self.counts[node]
            node = heads.find(word[j], first[node], first[node + 1])
            if node < 0:
                return 0
            j += 1
            at = 1

    def near(self, word: bytes) -> dict[bytes, int]:
        """The trie's words at distance one, with their counts."""
        first, cuts, heads, labels, rest, n = self.first, self.cuts, self.heads, self.labels, self._rest, len(word)
        found: dict[bytes, int] = {}
        node, at, before = 0, 0, -1
        for i in range(n + 1):
            own = word[i] if i < n else -1
            if own >= 0 and own != before and (count := rest(node, at, word, i + 1)):
                found[word[:i] + word[i + 1 :]] = count
            place = cuts[node] + at
            inside = place < cuts[node + 1]
            for child in (node,) if inside else range(first[node], first[node + 1]):
                letter, after = (labels[place], at + 1) if inside else (heads[child], 1)
                if own >= 0 and letter != own and (count := rest(child, after, word, i + 1)):
                    found[word[:i] + bytes((letter,)) + word[i + 1 :]] = count
                # after an equal letter the insertion was tried one place before
                if letter != before and (count := rest(child, after, word, i)):
                    found[word[:i] + bytes((letter,)) + word[i:]] = count
            if inside:
                if labels[place] != own:
                    break
                at += 1
            else:
                node = heads.find(own, first[node], first[node + 1]) if own >= 0 else -1
                if node < 0:
                    break
                at = 1
            before = own
        return found


def shared_prefix(a: bytes, b: bytes, start: int) -> int:
    """Where the words first differ, or the shorter one's end."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n - start, start), np.frombuffer(b, np.uint8, n - start, start)
    differs = np.flatnonzero(x != y)
    return start + (int(differs[0]) if len(differs) else n - start)


@frugal
def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the bytes of words that come before them there."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        sizes = np.array([len(w) for w in batch.column(0).to_pylist()], np.int64)
        ends = at + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sizes), part), pa.int32()), pa.array(ends - sizes, pa.int64()), pa.array(ends, pa.int64()), *batch.columns], ["part", "begins", "ends", "word", "n"])
        at = int(ends[-1]) if len(ends) else at


def _built(table: pa.Table) -> pa.Table:
    """A shard's trie."""
    rows = sorted(zip((w.encode("latin-1") for w in table["word"].to_pylist()), table["n"].to_pylist(), strict=True))
    trie = Trie.of([w for w, _ in rows], [n for _, n in rows])
    return pa.table([pa.array(table["shard"].to_pylist()[:1], pa.int64()), pa.array([trie.packed()], pa.binary())], ["shard", "trie"])


def trie_shards(words: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(word, n) -> (shard, trie), shards numbered from 0 in the words' order; each holds ``shard_bytes`` and a word at most."""
    ship(words.sparkSession)
    partitions = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = words.select("word", "n").repartitionByRange(partitions, "word").sortWithinPartitions("word")
    placed = materialize(ordered.mapInArrow(_placed, "part int, begins long, ends long, word string, n long"), "spelling-sorted")
    # a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.max("ends").alias("size")).select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    sharded = placed.join(F.broadcast(parts), "part").select(F.expr(f"(base + begins) div {shard_bytes}").alias("shard"), "word", "n")
    return sharded.groupBy("shard").applyInArrow(_built, "shard long, trie binary")


FOUND = "word string, n long, n_near long, best_n long, best string"


def _searched(tries):
    """A function over (word, n) that meets every word with every trie of a broadcast list."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Trie.unpacked(blob) for blob in tries.value]
        for batch in batches:
            out = []
            for word, n in rows_of(batch, "word", "n"):
                near: dict[bytes, int] = {}
                letters = word.encode("latin-1")
                for trie in own:
                    near.update(trie.near(letters))
                best = min(near.items(), key=lambda x: (-x[1], x[0]), default=None)
                out.append((word, n, len(near), best[1] if best else None, best[0].decode("latin-1") if best else None))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["word", "n", "n_near", "best_n", "best"])

    return run


def neighbours(words: DataFrame, shard_bytes: int = SHARD_BYTES, at_once: int = SHARDS_AT_ONCE) -> DataFrame:
    """(word, n) -> word, n, n_near, best_n, best: how many words are at distance one, and the most frequent of them."""
    spark = ship(words.sparkSession)
    tries = materialize(trie_shards(words, shard_bytes), "spelling-tries")
    shards = tries.agg(F.coalesce(F.max("shard") + 1, F.lit(0))).first()[0]
    # files of the vocabulary are few and small, the search is long
    spread = words.select("word", "n").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    path = scratch_path(spark, "spelling-near")
    for lo in range(0, max(shards, 1), at_once):
        group = spark.sparkContext.broadcast([bytes(r.trie) for r in tries.where(F.col("shard").between(lo, lo + at_once - 1)).collect()])
        spread.mapInArrow(_searched(group), FOUND).write.mode("append").option("compression", "zstd").parquet(path)
        group.destroy()
    discard_at_exit(spark, path)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))))
    met = spark.read.schema(FOUND).parquet(path).groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("found"))
    return met.select("word", "n", "n_near", (-F.col("found.less")).alias("best_n"), F.col("found.form").alias("best"))


def roots(links: DataFrame, most: int) -> DataFrame:
    """(word, form) -> (word, root): the end of every word's chain of forms, when no word occurs more than ``most`` times."""
    longest = max(1.0, math.log(max(most, FACTOR * LEAST_COUNT) / LEAST_COUNT, FACTOR))
    at = materialize(links.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(math.ceil(math.log2(longest)) + (longest > 1)):
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = materialize(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, at_once: int = SHARDS_AT_ONCE) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary."""
    words = materialize(vocabulary(docs, id_col, text_col), "spelling-words")
    formed = F.col("best_n") >= FACTOR * F.col("n")
    met = materialize(neighbours(words, shard_bytes, at_once).select("word", "n", "n_near", F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "spelling-forms")
    most = words.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    ends = roots(met.where("form is not null"), most)
    return met.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    return variants(table(spark, sf_dir, "documents"))


#: CRC-32 is a fold over bytes with a table that the polynomial gives; words at distance one share a deletion or are one.
ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(0, 8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT unnest(range(0, 256)) AS b)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents),
keyed AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (SELECT *, list_transform(range(1, CAST(length(hex(encode(key))) // 2 + 1 AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(key)), 2 * i - 1, 2) AS BIGINT)) AS b FROM keyed),
hashed AS (SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS BIGINT)]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM bytes, crc_table),
changed AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
steps AS (
  SELECT word, word AS at, form AS following FROM formed
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN formed f ON s.following = f.word)
SELECT f.word, f.form, s.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN steps s ON f.word = s.word AND s.following IS NULL
"""
