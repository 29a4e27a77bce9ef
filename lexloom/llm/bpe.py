"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

``encode``: texts are exploded into the pattern's matches (pre-tokens) with their positions, in the packed form of
``wordblocks``; each distinct pre-token of the corpus is encoded once; its ids are joined back to every block that
uses it and put at each position. ``decode`` joins ids with the token-byte table, which has one row per rank of the
vocabulary file and so is broadcast; ``round_trip`` does both.

Cases: a null text counts as empty and has no ids; ids of rows with equal doc_ids stay apart, since documents are kept
by their places in a block; null ids stay null; texts of any length are encoded whole; a pre-token of any length is one word; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, gather
from lexloom.llm.wordblocks import BLOCK_BYTES, Block, Bucket, back_to_blocks, cut_blocks, doc_starts, pack, per_bucket, unpack
from lexloom.session import ship

VOCABULARY = "byte_bpe_50k.tiktoken"
#: White space as the pattern's own engine has it (Python's regex counts four control characters more).
_SPACES = r"\t-\r \x85\xa0  -     　"
PIECES = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACES}\p{{L}}\p{{N}}]").replace(r"\s", f"[{_SPACES}]").replace(r"\S", f"[^{_SPACES}]"))
_IS_SPACE = regex.compile(f"[{_SPACES}]")


def load_ranks(path: str) -> bytes:
    """The vocabulary file's bytes; read on the driver and sent along, it has a fixed size."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


class _Segments(dict):
    """What stands between two lone spaces -> its number among the block's segments, or -1.

    A pre-token that holds a space starts with it, so between two characters that are no white space a space
    always starts a pre-token, and segments can be matched apart. -1: white space stands at the segment's edge.
    """

    def __init__(self, block: Block):
        super().__init__()
        self.block = block
        self.parts: list[tuple[int, ...]] = []

    def add(self, text: str) -> int:
        number = self.block.number
        self.parts.append(tuple([number(piece.encode("utf-8", "surrogatepass")) for piece in PIECES.findall(text)]))
        return len(self.parts) - 1

    def __missing__(self, segment: str) -> int:
        plain = segment and not _IS_SPACE.match(segment[0]) and not _IS_SPACE.match(segment[-1])
        found = self[segment] = self.add(" " + segment) if plain else -1
        return found


def split_pieces(block: Block, raw: bytes) -> np.ndarray:
    """The text's pre-tokens as the block's word numbers."""
    text = raw.decode("utf-8", "replace")
    if not text:
        return np.zeros(0, np.uint32)
    if not block.cache:
        block.cache["segments"] = _Segments(block)
    segments = block.cache["segments"]
    head, *rest = text.split(" ")
    number = block.number
    if head and not _IS_SPACE.match(head[-1]):
        found = list(map(segments.__getitem__, rest))
        if -1 not in found:
            first = [number(piece.encode("utf-8", "surrogatepass")) for piece in PIECES.findall(head)]
            parts = segments.parts
            for i in found:
                first += parts[i]
            return np.array(first, np.uint32)
    return np.array([number(piece.encode("utf-8", "surrogatepass")) for piece in PIECES.findall(text)], np.uint32)


def _encoder(raw: bytes):
    ranks = parse_ranks(raw)
    # words are the pattern's matches already: this encoding takes each as one piece
    encoding = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def handle(bucket: Bucket):
        ids = [[known] if (known := ranks.get(w)) is not None else encoding.encode_ordinary(w.decode("utf-8", "replace")) for w in bucket.words]
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.array([i for x in ids for i in x], np.uint32)
        starts = np.cumsum(sizes) - sizes
        return lambda here: pack(sizes[here].astype(np.uint32), flat[gather(starts[here], sizes[here])])

    return handle


def _encoded(docs: DataFrame, ranks: bytes, finish, schema: str, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    blocks = cut_blocks(docs, split_pieces, lambda _: False, id_col, text_col, block_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    state: dict = {}

    def handle(bucket: Bucket):
        if "encoder" not in state:
            state["encoder"] = _encoder(shared.value)
        return state["encoder"](bucket)

    return back_to_blocks(blocks, per_bucket(blocks, handle), finish, schema)


def encode(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids: each whole text's token ids, each match of the pattern encoded separately."""
    return _encoded(docs, ranks, _assemble, "doc_id long, ids array<int>", id_col, text_col, block_bytes)


def round_trip(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``decode(encode(...))`` with both ends in one pass over the blocks."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    state: dict = {}

    def finish(row: dict, found: list[tuple[np.ndarray, bytes]]) -> pa.Table:
        if "tokens" not in state:
            state["tokens"] = token_table(shared.value)
        return pa.Table.from_batches([_decoded(batch, state["tokens"]) for batch in _assemble(row, found).to_batches(max_chunksize=1000)], DECODED)

    return _encoded(docs, ranks, finish, DECODED_SCHEMA, id_col, text_col, block_bytes)


def _assemble(row: dict, found: list[tuple[np.ndarray, bytes]]) -> pa.Table:
    numbers = row["numbers"]
    parts = [(ranks, *unpack(blob)) for ranks, blob in found]
    ranks = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)]).astype(np.int64)
    sizes_by, flat = np.concatenate([np.zeros(0, np.uint32), *(p[1] for p in parts)]).astype(np.int64), np.concatenate([np.zeros(0, np.uint32), *(p[2] for p in parts)]).astype(np.int32)
    n = len(ranks)
    if n and (len(np.unique(ranks)) != n or ranks.max() != n - 1):
        raise RuntimeError("a block lacks words that it uses")
    sizes, starts = np.zeros(n, np.int64), np.zeros(n, np.int64)
    sizes[ranks] = sizes_by
    starts[ranks] = np.cumsum(sizes_by) - sizes_by
    each = sizes[numbers]
    ids = flat[gather(starts[numbers], each)]
    ends = np.concatenate([[0], np.cumsum(each)])[doc_starts(row)].astype(np.int32)
    return pa.table([pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))], ["doc_id", "ids"])


def token_table(ranks: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token bytes by id: where each begins, its size, and all bytes."""
    table = parse_ranks(ranks)
    tokens = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        tokens[rank] = token
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(tokens), np.uint8)


DECODED_SCHEMA = "doc_id long, ids array<int>, ids_sha256 string, decoded binary"
DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("decoded", pa.binary())])


def _decoded(batch: pa.RecordBatch, tokens: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """A batch of doc_id, ids with the hash of the ids and the bytes that the token table has for them."""
    starts, sizes, flat = tokens
    lists = batch.column(batch.schema.get_field_index("ids"))
    decoded, shas = [], []
    for i in range(len(lists)):
        ids = lists[i].values
        ids = np.zeros(0, np.int64) if ids is None else ids.to_numpy(zero_copy_only=False).astype(np.int64)
        decoded.append(flat[gather(starts[ids], sizes[ids])].tobytes())
        shas.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), lists.cast(pa.list_(pa.int32())), pa.array(shas, pa.string()), pa.array(decoded, pa.binary())], schema=DECODED)


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id, ids -> doc_id, ids, ids_sha256, decoded (bytes): a join of every id with the broadcast token-byte table.

    ids_sha256 is the hash of the ids as little-endian unsigned 32-bit integers, taken in the same pass.
    """
    shared = ship(encoded.sparkSession).sparkContext.broadcast(ranks)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_table(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield _decoded(batch.slice(at, 1000), tokens)

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED_SCHEMA)


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, ids, n_tokens, and the SHA-256 of the ids and of the decoded bytes."""
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    ranks = load_ranks(public_tokenizers.path(VOCABULARY))
    return digests(round_trip(table(spark, sf_dir, "documents"), ranks)).drop("ids")
