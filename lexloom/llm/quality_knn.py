"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

Texts become hashed term counts: words, word shapes, and whether a word repeats the one before it. A truncated
SVD of the labelled rows' TF-IDF matrix gives the latent space. Each document is scored by exact cosine
products with every labelled vector, in blocks; the ``NEIGHBOURS`` nearest vote with a power of their
similarity. The labelled matrix is broadcast: it has at most ``FIT_ROWS`` rows of ``DIMS`` numbers, whatever
the corpus holds, and no document is shuffled.

The bound on labelled rows is the parameter ``fit_rows``: the rows with the smallest hashes of their ids.

Cases: a null or empty text, or one without a known term, scores the labelled rows' mean; a null label is not
learnt from; several labels of one document count as their mean, at least 0.5 being good; without labelled rows
every score is 0.5; texts and words of any length count whole; repeated rows score alike; a null id is never held out and never labelled; labels, lang,
source and doc_id are no inputs of a score; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, id_and_bytes, rows_of
from lexloom.session import ship

FEATURES = 4096  # hashed terms
DIMS = 48  # latent dimensions
FIT_ROWS = 3000  # labelled rows that are learnt from, at most
NEIGHBOURS = 15
POWER = 8  # similarities vote with this power
THRESHOLD = 0.7
BLOCK = 512  # documents of one cosine product
CACHED_WORDS, CACHED_BYTES = 150_000, 1 << 24  # of words whose terms are remembered

_REPEAT = zlib.crc32(b"repeat") % FEATURES
_SHAPES = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"9"), (re.compile(rb"([^aA9])\1+"), rb"\1\1"))


class Terms(dict):
    """Word -> its two hashed terms: the lower-cased word and its shape. Forgets all when it holds too much."""

    held = 0

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= CACHED_WORDS or self.held >= CACHED_BYTES:
            self.clear()
            self.held = 0
        self.held += len(word)
        shape = word
        for pattern, to in _SHAPES:
            shape = pattern.sub(to, shape)
        found = self[word] = (zlib.crc32(b"w" + word.lower()) % FEATURES, zlib.crc32(b"s" + shape) % FEATURES)
        return found


def term_counts(raw: bytes | None, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of a text and the square roots of their shares."""
    words = (raw or b"").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    counted = Counter(words)
    n = np.fromiter(counted.values(), np.float64, len(counted))
    pairs = np.array([terms[w] for w in counted], np.int64)
    again = sum(map(bytes.__eq__, words, words[1:]))
    dense = np.bincount(pairs.ravel(), weights=np.repeat(n, 2), minlength=FEATURES)
    dense[_REPEAT] += again
    idx = np.flatnonzero(dense)
    return idx, np.sqrt(dense[idx] / len(words))


@frugal
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms = Terms()
    for batch in batches:
        idx, value, good = [], [], []
        for raw, label in rows_of(batch, "raw", "good"):
            i, v = term_counts(raw, terms)
            idx.append(i.astype("<i4").tobytes())
            value.append(v.astype("<f4").tobytes())
            good.append(label)
        yield pa.RecordBatch.from_arrays([pa.array(idx, pa.binary()), pa.array(value, pa.binary()), pa.array(good, pa.int32())], ["idx", "value", "good"])


class Model:
    """Inverse document frequencies, the projection, and the labelled unit vectors with their labels."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, int]], dims: int):
        labels = np.array([good for _, _, good in rows], np.float64)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        matrix = np.zeros((len(rows), FEATURES), np.float32)
        for r, (idx, value, _) in enumerate(rows):
            matrix[r, idx] = value
        df = (matrix > 0).sum(axis=0)
        self.idf = np.where(df > 0, np.log((1 + len(rows)) / np.maximum(df, 1)) + 0.2, 0.0).astype(np.float32)
        matrix *= self.idf
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
        vectors = latent_space(matrix, dims)
        signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        self.project = (vectors * np.where(signs == 0, 1, signs)).astype(np.float32)
        self.labelled = unit(matrix @ self.project)
        self.labels = labels.astype(np.float32)

    def vector(self, idx: np.ndarray, value: np.ndarray) -> np.ndarray:
        return (value * self.idf[idx]).astype(np.float32) @ self.project[idx]

    def vote(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        k = min(neighbours, len(self.labels))
        if k == 0:
            return np.full(len(vectors), self.prior)
        cosine = unit(vectors) @ self.labelled.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** POWER
        total = weight.sum(axis=1)
        score = np.where(total > 1e-12, (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12), self.prior)
        return np.clip(score, 0.0, 1.0)


def latent_space(matrix: np.ndarray, dims: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    basis = np.random.default_rng(5).standard_normal((matrix.shape[1], dims + 16)).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    small = (matrix @ basis).astype(np.float64)
    values, turn = np.linalg.eigh(small.T @ small)
    return basis @ turn[:, np.argsort(-values)[:dims]]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, dims: int = DIMS) -> Model:
    """Learn from labelled rows outside the held-out fold."""
    ship(docs.sparkSession)
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 2))
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("mean"))
        .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("mean") >= 0.5).cast("int").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    # fit_rows rows of 12 bytes at most, so this side may be broadcast
    learnt = id_and_bytes(docs).join(F.broadcast(chosen), "doc_id").select("raw", "good")
    found = learnt.mapInArrow(_count, "idx binary, value binary, good int").orderBy(F.xxhash64("idx", "value"), "idx", "value", "good").limit(fit_rows).collect()
    return Model([(np.frombuffer(r.idx, "<i4"), np.frombuffer(r.value, "<f4"), r.good) for r in found], dims)


def score_documents(docs: DataFrame, model: Model, neighbours: int = NEIGHBOURS, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns named in ``keep`` (the id, if none are) and ``_score``; one narrow pass over the documents."""
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    keep = keep or (id_col,)
    carried = dict.fromkeys([*keep, text_col])
    numbered = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carried)))
    text_at = list(carried).index(text_col)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, terms = shared.value, Terms()
        for batch in batches:
            raws = batch.column(text_at).cast(pa.binary())
            scores = [np.zeros(0)]
            for at in range(0, batch.num_rows, BLOCK):
                rows = [m.vector(*term_counts(raw.as_py(), terms)) for raw in raws.slice(at, BLOCK)]
                scores.append(m.vote(np.stack(rows), neighbours))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(np.concatenate(scores))], [*(f"c{i}" for i in range(len(keep))), "_score"])

    schema = numbered.select(*(f"c{i}" for i in range(len(keep)))).schema.add("_score", "double")
    return numbered.mapInArrow(run, schema).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), "_score")


def op5_quality_knn(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
