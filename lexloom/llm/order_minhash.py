"""Document fingerprints by Order MinHash.

Each of ``SKETCHES`` hash functions picks the ``PICK`` smallest of a text's occurrence-numbered character
k-mers, puts them back into text order and hashes the tuple. Two texts agree in a sketch only if they share
the picked k-mers in the same order, so the share of equal sketches follows edit distance, not only content.

``neighbour_fingerprints`` also compares each document with an edited copy of itself and with the next
document in descending id. It range-partitions the documents once; each task streams over its sorted rows
holding one document ahead, and the one document at each partition's end is finished from a table with two
rows a partition.

Cases: a null text counts as empty; an empty text has the fingerprint "" which is like itself only (1.0) and
unlike all others (0.0); a text shorter than a k-mer is one k-mer; rows with equal ids are ordered by a hash
of their text, then by their text, so equal rows give equal values whatever their order; null ids come last; texts of any
length are fingerprinted whole, a task holding two of them; the only row of a table is its own next document; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, id_and_bytes, mix64, rows_of, seeds
from lexloom.session import ship
from lexloom.sources.scratch import materialize

K = 8  # characters of a k-mer
SKETCHES = 32
PICK = 2
_AT_ONCE = 1 << 17  # hash values held at a time, as long as one function's fit

_BASE = np.uint64(0x100000001B3)
_A = (seeds(SKETCHES, 11) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (seeds(SKETCHES, 12) >> np.uint64(32)).astype(np.uint32)

RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_STAGED = f"part int, place string, raw binary, {RESULT}"


def kmer_hashes(chars: np.ndarray) -> np.ndarray:
    width = min(K, len(chars))
    n = len(chars) - width + 1
    h = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            h = h * _BASE + chars[j : j + n]
    return mix64(h)


def occurrences(h: np.ndarray) -> np.ndarray:
    """For each k-mer, how often it came before."""
    n = len(h)
    order = np.argsort(h)
    ranked = h[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    # number of the k-mer above, position below: a plain sort brings equal k-mers into text order
    keys = (np.cumsum(first).astype(np.uint64) << np.uint64(32)) | order.astype(np.uint64)
    keys.sort()
    at = np.arange(n)
    out = np.empty(n, np.uint64)
    out[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out


def fingerprint(chars: np.ndarray) -> np.ndarray:
    """One 32-bit value per sketch; nothing for an empty text."""
    if len(chars) == 0:
        return np.zeros(0, np.uint32)
    h = kmer_hashes(chars)
    with np.errstate(over="ignore"):
        x = (mix64(h + occurrences(h) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
        if len(x) <= PICK:
            places = np.broadcast_to(np.arange(len(x)), (SKETCHES, len(x)))
        else:
            step = max(1, _AT_ONCE // len(x))
            found = []
            for j in range(0, SKETCHES, step):
                v = x[None, :] * _A[j : j + step, None] + _B[j : j + step, None]
                rows, chosen = np.arange(len(v)), []
                for _ in range(PICK):
                    chosen.append(v.argmin(axis=1))
                    v[rows, chosen[-1]] = 0xFFFFFFFF
                found.append(np.sort(np.stack(chosen, axis=1), axis=1))
            places = np.concatenate(found)
        out = np.arange(1, SKETCHES + 1, dtype=np.uint64)
        for c in range(places.shape[1]):
            out = mix64(out * np.uint64(0xD1342543DE82EF95) + h[places[:, c]])
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    return float((a == b).mean())


def code_points(raw: bytes | None) -> np.ndarray:
    return np.frombuffer((raw or b"").decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), "<u4")


def as_text(chars: np.ndarray) -> bytes:
    return chars.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")


def compare(doc_id, chars: np.ndarray, own: np.ndarray, after: np.ndarray, after_print: np.ndarray) -> tuple:
    """A result row: ``chars`` against its edited text and against the next document."""
    third = len(chars) // 3
    edited = np.concatenate([chars[: len(chars) - third], after[:third]])
    changed = fingerprint(edited)
    return (
        doc_id,
        len(chars),
        hashlib.sha256(as_text(edited)).hexdigest(),
        own.astype(">u4").tobytes().hex(),
        changed.astype(">u4").tobytes().hex(),
        likeness(own, changed),
        likeness(own, after_print),
    )


def _result_columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@frugal
def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result rows of all but the partition's last document; its first and last ones come with their texts."""
    part = TaskContext.get().partitionId()

    def out(rows: list[tuple], place: str | None, raws: list) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([place] * n, pa.string()), pa.array(raws, pa.binary()), *_result_columns(rows)], ["part", "place", "raw", *_NAMES])

    held = None
    for batch in batches:
        done = []
        for doc_id, raw in rows_of(batch, "doc_id", "raw"):
            chars = code_points(raw)
            own = fingerprint(chars)
            if held is None:
                yield out([(doc_id, *[None] * 6)], "first", [raw])
            else:
                done.append(compare(*held[:3], chars, own))
            held = (doc_id, chars, own, raw)
        if done:
            yield out(done, None, [None] * len(done))
    if held is not None:
        yield out([(held[0], *[None] * 6)], "last", [held[3]])


@frugal
def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, raw, after in rows_of(batch, "doc_id", "raw", "after"):
            chars, following = code_points(raw), code_points(after)
            rows.append(compare(doc_id, chars, fingerprint(chars), following, fingerprint(following)))
        yield pa.RecordBatch.from_arrays(_result_columns(rows), _NAMES)


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its fingerprint, its edited text's, and their and the next document's likeness."""
    ship(docs.sparkSession)
    tie = F.xxhash64("raw")
    order = [F.col("doc_id").desc_nulls_last(), tie.asc()]
    dealt = id_and_bytes(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order, F.col("raw").asc_nulls_first())
    staged = materialize(dealt.mapInArrow(_stream, _STAGED), "order-minhash")
    # each partition's last document is followed by the next partition's first one: only partition numbers are ordered
    heads = staged.where("place = 'first'").select("part", F.col("raw").alias("after"))
    parts = heads.select("part")
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = parts.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(whole)).alias("next"))
    tails = staged.where("place = 'last'").select("part", "doc_id", "raw").join(following, "part")
    finished = tails.drop("part").join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "raw", "after").mapInArrow(_seams, RESULT)
    return staged.where("place is null").select(*_NAMES).unionByName(finished)


def op10_order_minhash(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
