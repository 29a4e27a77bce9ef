"""MinHash near-duplicates by a multi-index Hamming join.

A document's set of word shingles has a signature of ``VALUES`` minima, of which ``BITS`` bits each are kept. Signatures
are cut into ``CHUNKS`` chunks; by the pigeonhole principle, signatures that differ in at most ``SURE`` values agree in
some chunk up to one value, so every chunk is indexed under each choice of one value to leave out. All pairs within that
distance meet under some key. Those that meet are compared by set sizes and signatures first, key by key, and are candidates
unless they cannot be linked by their sizes, or differ in so many values (``most_differing``) as linked ones do with a
probability of 1e-12 at most. Candidates are connected to components, whose full sets are then compared exactly. Without that
first comparison, chance meetings of texts with a common passage form chains that grow faster than the corpus. Large
components that are still mere chains are compared key by key.

Documents with equal sets are one class from the start, so copies are never paired. Links come from ``connect_groups``.

Texts are not shuffled: the pass that takes signatures stores them in blocks of about ``BLOCK_BYTES``, bucketed by block, and
what is wanted for the exact comparison is asked of the block that holds it.

At a similarity of 0.85 a value differs with probability 0.15, and all eight chunks have two or more differing values
with probability 5.4e-7; at 0.8 it is 2.3e-5. These are the miss rates of a pair as a whole: the comparison of signatures adds
a millionth of them at most.

Cases: null, empty and blank texts have the empty set and link with nothing; texts with fewer words than a shingle have
one shingle; texts of any length are taken whole, a task holding the sets of the texts it compares; rows with equal ids are placed by their own texts, and classes with equal smallest ids count as linked; a
row without id gets the component of the rows with an equal set, else null, and is kept only then; an empty table gives
an empty table; ties need no order, a component being named by its smallest id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import WordHashes, block_numbers, frugal, id_and_bytes, lower_words, mix64, release, rows_of, seeds, word_shingles
from lexloom.llm.linking import Matcher, connect_groups, distinct_groups, set_matcher, shared_keys
from lexloom.llm.wordblocks import pack_words, unpack_words
from lexloom.session import ship
from lexloom.sources.scratch import materialize, materialize_bucketed

CHUNKS, WIDTH = 8, 5
VALUES = CHUNKS * WIDTH
BITS = 16
BLOCK_BYTES = 6_000_000
_BLOCKS = "block long, doc_ids array<long>, sizes array<long>, names array<binary>, signatures array<binary>, texts binary"
SURE = 2 * CHUNKS - 1  # differing values up to which no pair is missed
MISSED = 1e-12  # probability with which a linked pair's signatures differ in too many values
TOGETHER = 1024  # signatures of a key that are compared in one task

#: What is compared before full sets: a signature and the set's size.
_OUTLINE = np.dtype([("values", "<u2", VALUES), ("size", ">i8")])

_A = (seeds(VALUES, 21) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (seeds(VALUES, 22) >> np.uint64(32)).astype(np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """VALUES minima of a non-empty set, BITS bits each."""
    low, high = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty(VALUES, np.uint32)
    step = max(1, (1 << 17) // len(low))
    with np.errstate(over="ignore"):
        for j in range(0, VALUES, step):
            out[j : j + step] = (low[None, :] * _A[j : j + step, None] + (high ^ (high >> np.uint32(15)))[None, :] * (_B[j : j + step, None] | np.uint32(1))).min(axis=1)
        # a minimum's own low bits are uneven; scrambled ones are not
        return (mix64(out.astype(np.uint64)) >> np.uint64(64 - BITS)).astype("<u2")


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """n x VALUES -> n x (CHUNKS * WIDTH) keys: each chunk without each of its values."""
    with np.errstate(over="ignore"):
        parts = signatures.reshape(len(signatures), CHUNKS, WIDTH).astype(np.uint64)
        keys = np.empty((len(signatures), CHUNKS, WIDTH), np.uint64)
        for left_out in range(WIDTH):
            h = np.broadcast_to(np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left_out + 1), parts.shape[:2])
            for v in range(WIDTH):
                if v != left_out:
                    h = mix64(h * np.uint64(0xD1342543DE82EF95) + parts[:, :, v])
            keys[:, :, left_out] = h
    return keys.reshape(len(signatures), -1)


def set_keys(sets: list[bytes]) -> np.ndarray:
    """The keys of documents, from the hashes of their shingles."""
    return chunk_keys(np.stack([signature(np.frombuffer(s, "<u8")) for s in sets]))


def most_differing(percent: int) -> int:
    """The least number of values in more than which sets of that similarity differ with a probability of MISSED at most."""
    p, tail = 1 - percent / 100, 0.0
    for d in range(VALUES, 0, -1):
        tail += comb(VALUES, d) * p**d * (1 - p) ** (VALUES - d)
        if tail > MISSED:
            return d
    return 0


def outline_matcher(percent: int) -> Matcher:
    """Payloads are outlines; linked unless the sizes or the differing values of two sets rule ``percent`` out."""
    most = most_differing(percent)

    def prepare(payloads: list[bytes]):
        outlines = np.frombuffer(b"".join(payloads), _OUTLINE)
        values, sizes = np.ascontiguousarray(outlines["values"]), outlines["size"].astype(np.int64)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            out = (100 * sizes[others] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[others])
            out[out] = (values[others[out]] != values[i]).sum(axis=1) <= most
            return out

        return linked

    return prepare


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """(id, signature, size) -> (id, root): components of what meets under a key and is not ruled out by its outline."""
    met = materialize(shared_keys(classes.select("id", "signature").mapInArrow(_keys, "key long, id long")), "near-dup-met")
    groups = materialize(distinct_groups(met.select("key", "id", F.col("id").alias("root"), F.lit(VALUES).alias("size"))), "near-dup-keys")
    outlines = classes.select("id", F.concat("signature", F.unhex(F.lpad(F.hex("size"), 16, "0"))).alias("payload"))
    placed = met.join(groups, "key").join(outlines, "id").select(F.col("key").alias("group"), "id", "payload", "n", "weight")
    return connect_groups(materialize(placed, "near-dup-outlines"), outline_matcher(percent), "near-dup-rough", chunk=TOGETHER)


def _cut(words: int, buckets: int, block_bytes: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers = WordHashes(), block_numbers(TaskContext.get().partitionId(), buckets)
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary())]
            columns = [pa.array([[h[i] for h in held]], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([pa.array([next(numbers)], pa.int64()), *columns, pa.array([pack_words([h[4] for h in held])], pa.binary())], ["block", "doc_ids", "sizes", "names", "signatures", "texts"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for doc_id, raw in rows_of(batch.slice(at, 256), "doc_id", "raw"):
                    shingles = word_shingles(hashes.of(lower_words(raw)), words)
                    known = len(shingles) > 0
                    held.append((doc_id, len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()) if known else None, signature(shingles).tobytes() if known else None, raw or b""))
                    size += len(held[-1][4])
                    if size >= block_bytes:
                        yield block()
                        held, size = [], 0
                        release()
        if held:
            yield block()

    return run


def cut_blocks(docs: DataFrame, words: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, raw) -> the table of blocks: ids, set sizes, names of sets, signatures and, apart from them, texts."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize_bucketed(docs.mapInArrow(_cut(words, buckets, block_bytes), _BLOCKS), "block", "near_dup_blocks", compression="none")


def features_of(blocks: DataFrame) -> DataFrame:
    """(block, row, doc_id, n_shingles, name, signature) of every document; texts are not read."""
    each = blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", "sizes", "names", "signatures")).alias("row", "d"))
    return each.select("block", "row", F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").alias("n_shingles"), F.col("d.names").alias("name"), F.col("d.signatures").alias("signature"))


@frugal
def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4000):
            part = batch.slice(at, 4000)
            keys = chunk_keys(np.frombuffer(b"".join(part.column(1).to_pylist()), "<u2").reshape(-1, VALUES))
            ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids, pa.int64())], ["key", "id"])


def _sets(words: int):
    """Blocks with what is wanted of them -> (group, id, payload, n, weight)."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for packed, wanted in rows_of(batch, "texts", "wanted"):
                texts = unpack_words(packed)[0]
                rows = [(w["root"], w["id"], word_shingles(hashes.of(lower_words(texts[w["row"]])), words).astype("<u8").tobytes(), w["n"], w["weight"]) for w in wanted]
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["group", "id", "payload", "n", "weight"])

    return run


def wanted_sets(blocks: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(block, row, id, root, n, weight) -> (group, id, payload, n, weight): the full sets, from the blocks that hold their texts."""
    # grows with the corpus, so the plan is the same at every size: nothing is broadcast
    asked = wanted.groupBy("block").agg(F.collect_list(F.struct("row", "id", "root", "n", "weight")).alias("wanted"))
    met = blocks.select("block", "texts").join(asked.hint("merge"), "block").select("texts", "wanted")
    return met.mapInArrow(_sets(words), "group long, id long, payload binary, n long, weight long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked at ``percent`` similarity of ``words``-word shingles."""
    ship(docs.sparkSession)
    blocks = cut_blocks(id_and_bytes(docs, id_col, text_col), words)
    features = features_of(blocks)
    known = features.where("name is not null and doc_id is not null").groupBy("name").agg(F.min(F.struct("doc_id", "block", "row")).alias("at"), F.first("signature").alias("signature"), F.first("n_shingles").alias("size"))
    classes = materialize(known.select("name", F.col("at.doc_id").alias("id"), "at.block", "at.row", "signature", "size"), "near-dup-classes")
    some = materialize(candidates(classes, percent).join(classes.select("id", "block", "row", "size"), "id"), "near-dup-some")
    # written, as a join of two plain shuffles can be split where one component has many of the documents
    sizes = materialize(some.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("weight")), "near-dup-sizes")
    compared = wanted_sets(blocks, some.join(sizes, "root"), words)
    exact = connect_groups(materialize(compared, "near-dup-sets"), set_matcher(percent), "near-dup-exact", set_keys)
    named = classes.select("name", "id").join(exact, "id", "left").select("name", F.coalesce("root", "id").alias("component"))
    placed = features.select("doc_id", "n_shingles", "name").join(named, "name", "left")
    component = F.coalesce("component", F.col("doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), component.isNull()).alias("kept"))


def op4_near_dup(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


#: All pairs that share a shingle are counted, and reachability is followed to its end: for small tables.
ORACLE = r"""
WITH RECURSIVE
words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN either e ON r.b = e.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id, c.component_id = n.doc_id AS kept
FROM sizes n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = n.doc_id
"""
