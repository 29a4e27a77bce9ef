"""A shuffle of distinct words: look at every word of a corpus once, and bring the findings back to its places.

Exploding every occurrence would shuffle several times the corpus. Instead documents are cut into blocks of about
``BLOCK_BYTES``. A block holds, once each, its distinct words, and every document's words as positions in that list,
in text order. Of a block only the distinct words travel: packed by word bucket to where each distinct word of the
corpus is handled once (``per_bucket``), and the findings back to the block, where they are put at each position.

The blocks are a table in the shared folder, bucketed by block (a task's blocks lie in one bucket, as one file), so both ways read the same blocks even if executors are
lost, and the texts' word positions are never shuffled. A word as frequent as may be is one entry per block; the largest
thing a task holds is a block, a very long document, or the words of one bucket, of which there are more the more shuffle
partitions are set. A block sends a row for each bucket that it has words of, so never more rows than distinct words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import block_numbers, frugal, id_and_bytes, release, rows_of
from lexloom.session import ship
from lexloom.sources.scratch import materialize_bucketed

BLOCK_BYTES = 15_000_000
BUCKETS_A_PARTITION = 2

BLOCK_SCHEMA = "block long, doc_ids array<long>, n_words array<int>, flags array<boolean>, payload binary, parts array<struct<bucket:int,words:binary>>"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers or floats, by byte planes, compressed."""
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.dtype.itemsize, ord(a.dtype.kind)))], "<i8").tobytes()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() if len(a) else b"" for a in arrays]
    return zstandard.compress(head + b"".join(planes), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    heads = np.frombuffer(raw, "<i8", 3 * count, 8).reshape(count, 3).tolist()
    at, out = 8 + 24 * count, []
    for n, width, kind in heads:
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(np.dtype(f"<{chr(kind)}{width}")).reshape(n))
        at += n * width
    return out


def pack_words(words: list[bytes], *more: np.ndarray) -> bytes:
    joined = np.frombuffer(b"".join(words), np.uint8)
    return pack(np.array([len(w) for w in words], np.uint32), joined, *more)


def unpack_words(blob: bytes) -> tuple[list[bytes], list[np.ndarray]]:
    sizes, joined, *more = unpack(blob)
    ends = np.cumsum(sizes, dtype=np.int64)
    flat = joined.tobytes()
    return [flat[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)], more


class Block:
    """Documents as arrays of word numbers. ``split`` gives a text's word numbers and may call ``number``."""

    def __init__(self, split: Callable[[Block, bytes], np.ndarray]):
        self.words: list[bytes] = []
        self.numbers: dict[bytes, int] = {}
        self.cache: dict = {}  # for split
        self.split = split
        self.size = 0
        self.doc_ids: list = []
        self.flags: list[bool] = []
        self.texts: list[np.ndarray] = []

    def number(self, word: bytes) -> int:
        found = self.numbers.get(word)
        if found is None:
            found = self.numbers[word] = len(self.words)
            self.words.append(word)
        return found

    def add(self, doc_id, raw: bytes, flag: bool) -> None:
        self.doc_ids.append(doc_id)
        self.flags.append(flag)
        self.texts.append(self.split(self, raw))
        self.size += len(raw)

    def row(self, number: int, buckets: int) -> pa.RecordBatch:
        flat = np.concatenate([np.zeros(0, np.uint32), *self.texts])
        sizes = np.array([len(t) for t in self.texts], np.int32)
        total = np.bincount(flat, minlength=len(self.words))
        flagged = np.bincount(flat[np.repeat(np.array(self.flags, bool), sizes)], minlength=len(self.words))
        order = np.argsort(-total, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        of = np.fromiter((xxhash.xxh32_intdigest(w) for w in self.words), np.uint32, len(self.words)) % np.uint32(buckets)
        by_bucket = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[by_bucket], np.arange(buckets + 1))
        parts = []
        for b in range(buckets):
            own = by_bucket[cuts[b] : cuts[b + 1]]
            if len(own):
                parts.append({"bucket": b, "words": pack_words([self.words[i] for i in own], rank[own], flagged[own].astype(np.uint32))})
        kind = pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([self.doc_ids], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int32())), pa.array([self.flags], pa.list_(pa.bool_())), pa.array([pack(rank[flat])], pa.binary()), pa.array([parts], kind)],
            ["block", "doc_ids", "n_words", "flags", "payload", "parts"],
        )


def cut_blocks(docs: DataFrame, split: Callable[[Block, bytes], np.ndarray], flag: Callable[[int | None], bool], id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The table of blocks. ``flag`` marks documents; each word's occurrences in marked ones travel with it."""
    spark = ship(docs.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_A_PARTITION * partitions

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_numbers(TaskContext.get().partitionId(), partitions)
        block = Block(split)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for doc_id, raw in rows_of(batch.slice(at, 256), "doc_id", "raw"):
                    block.add(doc_id, raw or b"", flag(doc_id))
                    if block.size >= block_bytes:
                        yield block.row(next(numbers), buckets)
                        block = Block(split)
                        release()
        if block.doc_ids:
            yield block.row(next(numbers), buckets)

    return materialize_bucketed(id_and_bytes(docs, id_col, text_col).mapInArrow(run, BLOCK_SCHEMA), "block", "blocks")


class Bucket:
    """The words of one bucket from all blocks: ``words`` are distinct, ``counts`` their marked occurrences."""

    def __init__(self, table: pa.Table):
        numbers: dict[bytes, int] = {}
        self.uses: list[tuple[int, np.ndarray, np.ndarray]] = []  # block, ranks there, numbers here
        counts = []
        for block, blob in zip(table["block"].to_pylist(), table["words"].to_pylist(), strict=True):
            words, (ranks, flagged) = unpack_words(blob)
            here = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
            self.uses.append((block, ranks, here))
            counts.append(flagged)
        self.words = list(numbers)
        every = np.concatenate([np.zeros(0, np.int64), *(here for _, _, here in self.uses)])
        weight = np.concatenate([np.zeros(0, np.uint32), *counts])
        self.counts = np.zeros(len(numbers), np.int64)
        np.add.at(self.counts, every, weight.astype(np.int64))


def by_bucket(blocks: DataFrame):
    return blocks.select("block", F.explode("parts").alias("part")).select("block", "part.bucket", "part.words").groupBy("bucket")


def per_bucket(blocks: DataFrame, handle: Callable[[Bucket], Callable[[np.ndarray], bytes]]) -> DataFrame:
    """(block, found): ``handle`` looks at a bucket's distinct words and returns what packs the findings of some."""

    def work(table: pa.Table) -> pa.Table:
        bucket = Bucket(table)
        packed = handle(bucket)
        rows = [(block, pack(ranks), packed(here)) for block, ranks, here in bucket.uses]
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["block", "ranks", "found"])

    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        release()
        return out

    return by_bucket(blocks).applyInArrow(run, "block long, ranks binary, found binary")


def back_to_blocks(blocks: DataFrame, found: DataFrame, finish: Callable[[dict, list[tuple[np.ndarray, bytes]]], pa.Table], schema: str) -> DataFrame:
    """``finish`` gets a block's row, with ``numbers`` (all its words by rank), and its (ranks, findings)."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            row["numbers"] = unpack(row.pop("payload"))[0]
            out.append(finish(row, [(unpack(r)[0], f) for r, f in zip(right["ranks"].to_pylist(), right["found"].to_pylist(), strict=True)]))
        return pa.concat_tables(out) if len(out) != 1 else out[0]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = work(left, right)
        release()
        return out

    return blocks.select("block", "doc_ids", "n_words", "flags", "payload").groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, schema)


def doc_starts(row: dict) -> np.ndarray:
    """Where each document's words begin among the block's, and where the last ends."""
    return np.concatenate([[0], np.cumsum(row["n_words"], dtype=np.int64)])
