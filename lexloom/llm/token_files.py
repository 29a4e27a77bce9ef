"""Token ids as files of variable-length codes.

``tokenize`` encodes whole texts. A space between two visible characters always begins a new match of the vocabulary's
pre-tokenizer, as does a line end between two, so texts are cut there, each distinct piece is encoded once a worker by the tokenizer library, and documents
are put together from pieces. ``write`` numbers ids by their frequency in the whole corpus, so that frequent ones are small,
and stores each number in one to four bytes; the byte counts of four numbers make one control byte, and control bytes stand
apart from the data. ``read`` looks up in one table, by control byte, how many bytes each of four numbers has, and gathers the
bytes of each place from the data.

A folder of files holds ``ids`` (number -> id, at most a row for each id of the vocabulary), ``blocks`` (documents in ascending
id order, about ``BLOCK_IDS`` ids a block) and ``parts`` (how many ids come before each range of documents). They are Parquet
files of binary columns, written by Spark, so they can lie in any store. Documents are sorted by ranges, and where a document starts is the sum of
its range's, its block's and its own offset, so no task sees more than a range.

Cases: a null or empty text has the end id alone; null ids come last; rows of equal ids are ordered by their tokens, so equal
rows may stand in any order without changing a value; texts of any length are encoded whole and lie in one block; special
tokens' strings in a text are ordinary text; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, gather, id_and_bytes, rows_of
from lexloom.session import ship
from lexloom.sources.scratch import discard_at_exit, materialize, scratch_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
BLOCK_IDS = 1 << 18
PIECES_HELD = 1_500_000  # by a worker, which keeps them from task to task
CHARS_HELD = 24 << 20
TOGETHER = 500  # new pieces that are encoded by one call
PORTION, ROWS = 8_000_000, 8192  # bytes of text and rows whose distinct pieces are looked up together

TOKENIZED = "doc_id long, ids binary, id int, n long"
BLOCKS = "part int, block int, begins long, n long, doc_ids array<long>, sizes array<int>, control binary, data binary"

#: How many more bytes than one each of four numbers has, by control byte.
MORE_BYTES = np.array([[(control >> 2 * lane) & 3 for lane in range(4)] for control in range(256)], np.uint8)


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data of unsigned 32-bit numbers; zeros fill the last four up."""
    padded = np.zeros(-(-len(numbers) // 4) * 4, "<u4")
    padded[: len(numbers)] = numbers
    more = sum((padded > limit).view(np.uint8) for limit in (0xFF, 0xFFFF, 0xFFFFFF))
    four = more.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    ends = np.cumsum(more + np.uint8(1), dtype=np.int64)
    begins = ends - more - 1
    data, lanes = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8), padded.view(np.uint8).reshape(-1, 4)
    data[begins] = lanes[:, 0]
    for lane in (1, 2, 3):
        wide = np.flatnonzero(more >= lane)
        data[begins[wide] + lane] = lanes[wide, lane]
    return control.tobytes(), data.tobytes()


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    more, data = MORE_BYTES[np.frombuffer(control, np.uint8)].reshape(-1), np.frombuffer(data, np.uint8)
    begins = np.cumsum(more + np.uint8(1), dtype=np.int64) - more - 1
    out = data[begins].astype("<u4")
    for lane in (1, 2, 3):
        wide = np.flatnonzero(more >= lane)
        out[wide] |= data[begins[wide] + lane].astype("<u4") << np.uint32(8 * lane)
    return out[:n]


def _packed(ids: np.ndarray) -> bytes:
    """Ids of two or four bytes, compressed, after the number of bytes."""
    return bytes([ids.itemsize]) + zstandard.compress(ids, 1)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(memoryview(blob)[1:]), f"<u{blob[0]}")


def _visible(char: str) -> bool:
    return char.isalnum() or unicodedata.category(char)[0] in "LNPSM"


class Pieces(dict):
    """Piece -> its number.

    A piece is a space or a line end and what follows it up to the next one, or a text's beginning up to the first one; a
    tuple of one is any other text. Pieces of letters are one match, so only the library's model is asked for their ids. One
    that begins with a line end, or ends in a punctuation mark after a letter, is put together, as a match ends there too.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        # what is new, with numbers: words as the model takes them, pieces with a space, other texts, and four numbers of what is put together
        self.words: list[str] = []
        self.spaced: list[str] = []
        self.texts: list[str] = []
        self.word_numbers, self.spaced_numbers, self.text_numbers, self.built = array("q"), array("q"), array("q"), array("q")
        self.chars = self.known = 0
        self.starts, self.sizes, self.flat, self.edges = array("q"), array("q"), array("I"), array("B")
        self.nothing = self._add((), 0)
        self.line_end = self[(b"\n",)]
        self.mark_of_lines = tokenizer.encode("\n", add_special_tokens=False).ids[0]

    def __missing__(self, piece: bytes | tuple[bytes]) -> int:
        if isinstance(piece, tuple):
            self.texts.append(text := piece[0].decode("utf-8", "replace"))
            self.text_numbers.append(self.known)
            return self._add(piece, len(text))
        text = piece.decode("utf-8", "replace")
        lead = text[:1]
        body = text[1:] if lead in _LEADS else text
        if body.isalpha() and ((plain := body.isascii()) or max(body) < _LETTERS):
            if lead == "\n":
                return self._build(piece, piece[1:], self.nothing)
            word = body if plain else body.encode().decode("latin-1").translate(_BYTE_LEVEL)
            self.words.append(_SPACE + word if lead == " " else word)
            self.word_numbers.append(self.known)
            return self._add(piece, len(text))
        edges = (_BEGINS * _visible(body[0]) | _ENDS * _visible(body[-1])) if body else 0
        if edges == _BEGINS | _ENDS:
            if len(body) > 1 and body[-1] in _MARKS and body[-2].isalpha():
                return self._build(piece, piece[1:-1] if lead == "\n" else piece[:-1], self[piece[-1:]])
            if lead == "\n":
                return self._build(piece, piece[1:], self.nothing)
            if lead == " ":
                self.spaced.append(text)
                self.spaced_numbers.append(self.known)
            else:
                self.texts.append(text)
                self.text_numbers.append(self.known)
        return self._add(piece, len(text), edges)

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """The numbers of distinct new pieces. All but a few are added by arrays: words, words with a mark, and what else has visible ASCII at its edges."""
        flat = np.frombuffer(b"".join(new), np.uint8)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        if not len(flat):
            return np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        begins, other = ends - sizes, ~_in_letters(flat, ends)
        lined, spaced, last = flat[begins] == 10, flat[begins] == 32, flat[ends - 1]
        led = lined | spaced
        other[begins[led]] = False
        others, bare = np.add.reduceat(other, begins, dtype=np.int64), sizes - led
        letters = (others == 0) & (bare > 0)
        marked = (others == 1) & (bare > 1) & _IS_MARK[last]
        words, built = letters & ~lined, letters & lined | marked
        plain = spaced & (bare > 1) & (others > 0) & ~marked & _IS_VISIBLE[flat[ends - np.maximum(bare, 1)]] & _IS_VISIBLE[last]
        plain &= ~_IS_MARK[last] | other[ends - 2]
        numbers = np.full(len(new), -1)
        numbers[words] = self._learn_words([new[i] for i in np.flatnonzero(words).tolist()])
        numbers[plain] = own = self._add_all(few := [new[i] for i in np.flatnonzero(plain).tolist()])
        self.spaced += [piece.decode("utf-8", "replace") for piece in few]
        self.spaced_numbers.frombytes(own.tobytes())
        at = np.flatnonzero(built)
        heads = [new[i][a:b] for i, a, b in zip(at.tolist(), lined[at].tolist(), (sizes - marked)[at].tolist(), strict=True)]
        self._learn_words([word for word in dict.fromkeys(heads) if word not in self])
        marks = np.full(256, self.nothing)
        for mark in np.unique(last[marked]).tolist():
            marks[mark] = self[bytes([mark])]
        parts = np.fromiter(map(self.__getitem__, heads), np.int64, len(at))
        numbers[at] = own = self._add_all([new[i] for i in at.tolist()])
        columns = [own, np.where(lined[at], self.line_end, self.nothing), parts, np.where(marked[at], marks[last[at]], self.nothing)]
        self.built.frombytes(np.column_stack(columns).tobytes())
        rest = np.flatnonzero(numbers < 0)
        numbers[rest] = [self[new[i]] for i in rest.tolist()]
        return numbers

    def _learn_words(self, new: list[bytes]) -> np.ndarray:
        ends = list(accumulate(map(len, new)))
        every = _BYTE_LEVELS[np.frombuffer(b"".join(new), np.uint8)].tobytes().decode("utf-16-le")
        self.words += [every[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        numbers = self._add_all(new)
        self.word_numbers.frombytes(numbers.tobytes())
        return numbers

    def _add_all(self, new: list[bytes]) -> np.ndarray:
        numbers = np.arange(self.known, self.known + len(new))
        self.update(zip(new, numbers.tolist(), strict=True))
        self.edges.frombytes(bytes([_BEGINS | _ENDS]) * len(new))
        self.chars += sum(map(len, new))
        self.known += len(new)
        return numbers

    def _build(self, piece: bytes, word: bytes, mark: int) -> int:
        word = self[word]
        self.built.extend((self.known, self.line_end if piece[:1] == b"\n" else self.nothing, word, mark))
        return self._add(piece, len(piece))

    def _add(self, piece: bytes | tuple, chars: int, edges: int = 3) -> int:
        self.chars += chars
        number = self[piece] = self.known
        self.known += 1
        self.edges.append(edges)
        return number

    def of(self, text: str) -> np.ndarray:
        """The numbers of a text's pieces."""
        return self.of_each(pa.array([text.encode()], pa.binary()))[0]

    def of_each(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' pieces, and where among them each text begins and the last ends.

        Arrow finds the distinct pieces, and only these are looked up. What lies between two pieces that are not to be cut
        apart is one piece with both.
        """
        texts = texts.cast(pa.binary()).fill_null(b"")
        _, ends, data = texts.buffers()
        at = np.frombuffer(ends, np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
        at = at - at[0]
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        heads = (raw == 32) | (raw == 10)
        heads[at[:-1][at[:-1] < at[1:]]] = True
        begins = np.flatnonzero(heads)
        cuts = np.append(begins, len(raw)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
        distinct, places = found.dictionary.to_numpy(zero_copy_only=False), found.indices.to_numpy()
        own = np.fromiter(map(self.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(own < 0)
        own[new] = self._learn(distinct[new].tolist())
        edges = np.frombuffer(self.edges, np.uint8)[own]
        numbers, first = own[places], np.searchsorted(begins, at)
        if edges.min() == _BEGINS | _ENDS:
            return numbers, first
        edges = edges[places]
        alone = np.append(True, (edges[:-1] & _ENDS > 0) & (edges[1:] & _BEGINS > 0))
        alone[first[:-1][first[:-1] < first[1:]]] = True
        heads = np.flatnonzero(alone)
        ends = np.append(heads[1:], len(numbers))
        odd = np.flatnonzero((ends - heads > 1) | (edges[heads] != _BEGINS | _ENDS))
        numbers, flat = numbers[heads], memoryview(raw)
        for i, a, b in zip(odd.tolist(), cuts[heads[odd]].tolist(), cuts[ends[odd]].tolist(), strict=True):
            numbers[i] = self[(bytes(flat[a:b]),)]
        return numbers, np.searchsorted(heads, first)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded_together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that begin with a space and hold no line end, and their sizes: a line end between two is a match of its own."""
        every, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(texts), TOGETHER):
            part = texts[at : at + TOGETHER]
            ids = np.array(self._encoded(["\n".join(part)])[0], np.uint32)
            cuts = np.flatnonzero(ids == self.mark_of_lines)
            if len(cuts) != len(part) - 1:
                raise RuntimeError("the vocabulary's pre-tokenizer is not the byte-level one")
            every.append(np.delete(ids, cuts))
            sizes.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
        return np.concatenate(every), np.concatenate(sizes)

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encode what is new; where each piece's ids start, how many they are, and all ids."""
        tokenize = self.tokenizer.model.tokenize
        found = [[token.id for token in tokenize(word)] for word in self.words]
        found += self._encoded(self.texts)
        numbers = np.concatenate([np.array(n, np.int64) for n in (self.word_numbers, self.text_numbers)])
        spaced, (spaced_ids, spaced_sizes) = np.array(self.spaced_numbers, np.int64), self._encoded_together(self.spaced)
        built = np.array(self.built, np.int64).reshape(-1, 4)
        self.words, self.spaced, self.texts = [], [], []
        self.word_numbers, self.spaced_numbers, self.text_numbers, self.built = array("q"), array("q"), array("q"), array("q")
        more = self.known - len(self.starts)
        self.starts.frombytes(bytes(8 * more))
        self.sizes.frombytes(bytes(8 * more))
        starts, sizes = np.frombuffer(self.starts, np.int64), np.frombuffer(self.sizes, np.int64)

        def place(at: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
            starts[at] = len(self.flat) + np.cumsum(n) - n
            sizes[at] = n
            self.flat.frombytes(ids.astype(np.uint32).tobytes())

        place(numbers, np.fromiter(map(len, found), np.int64, len(found)), np.fromiter(chain.from_iterable(found), np.uint32))
        place(spaced, spaced_sizes, spaced_ids)
        if len(built):
            parts = built[:, 1:].ravel()
            ids = np.frombuffer(self.flat, np.uint32)[gather(starts[parts], sizes[parts])]
            place(built[:, 0], sizes[built[:, 1:]].sum(axis=1), ids)
        return starts, sizes, np.frombuffer(self.flat, np.uint32) if self.flat else np.zeros(0, np.uint32)


_BEGINS, _ENDS = 1, 2  # a piece's first and last character are visible, its leading space or line end aside
_LEADS = frozenset(" \n")
_MARKS = frozenset(".,;:!?")
_LETTERS = "\u0530"  # letters below are letters in every version of Unicode that a library may have
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
#: Byte -> the character for it in a byte-level vocabulary.
_BYTE_LEVEL = {byte: chr(256 + n) for n, byte in enumerate(b for b in range(256) if b not in _PRINTED)}

_SPACE = _BYTE_LEVEL[32]
_BYTE_LEVELS = np.array([ord(_BYTE_LEVEL.get(byte, chr(byte))) for byte in range(256)], "<u2")
_IS_MARK = np.array([chr(byte) in _MARKS for byte in range(256)])
_IS_VISIBLE = np.array([32 < byte < 127 for byte in range(256)])  # in ASCII
_IS_LETTER = np.array([chr(code).isalpha() and code < 0x500 for code in range(0x800)])


def _in_letters(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 are of letters that have one byte, or two and a lead byte below D4; texts end at ``ends``."""
    after = np.append(flat[1:], np.uint8(0))
    after[ends - 1] = 0
    two = (flat >= 0xC2) & (flat < 0xD4) & (after & 0xC0 == 0x80)
    two &= _IS_LETTER[(flat & 31).astype(np.uint16) << 6 | after & 63]
    out = two | (flat < 128) & _IS_LETTER[flat & 127]
    out[1:] |= two[:-1]
    return out


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``PORTION`` bytes of text."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, min(at + ROWS, int(np.searchsorted(ends, before + PORTION, "right"))))
        yield at, to
        at = to


_HELD: dict[bytes, Pieces] = {}


def _pieces(key: bytes, vocabulary: bytes) -> Pieces:
    """The worker's pieces, or new ones when it holds enough; ``key`` tells vocabularies apart."""
    found = _HELD.get(key)
    if found is None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(vocabulary)
        tokenizer.encode_special_tokens = True  # their strings are ordinary text
        found = _HELD[key] = Pieces(tokenizer)
    elif found.known > PIECES_HELD or found.chars > CHARS_HELD:
        found = _HELD[key] = Pieces(found.tokenizer)
    return found


def tokenize(docs: DataFrame, vocabulary: bytes, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids), packed and with the end id, and each task's counts of ids as rows (id, n)."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(vocabulary)
    key = hashlib.sha256(vocabulary).digest()

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(key, shared.value)
        counts = np.zeros(pieces.tokenizer.get_vocab_size() + end_id + 1, np.int64)
        narrow = np.uint16 if len(counts) <= 1 << 16 else np.uint32
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index("raw"))
            for at, to in _portions(raw):
                part = batch.slice(at, to - at)
                pieces = _pieces(key, shared.value)
                numbers, first = pieces.of_each(raw.slice(at, to - at))
                starts, sizes, flat = pieces.settle()
                packed = []
                for a in range(0, len(first) - 1, 128):
                    begins = first[a : a + 129]
                    own = numbers[begins[0] : begins[-1]]
                    n = sizes[own]
                    ends = np.append(0, np.cumsum(n))[begins[1:] - begins[0]]
                    ids = np.insert(flat[gather(starts[own], n)], ends, end_id)
                    counts += np.bincount(ids, minlength=len(counts))
                    packed += map(_packed, np.split(ids.astype(narrow), ends[:-1] + np.arange(1, len(ends))))
                del starts, sizes, flat  # the arrays behind them cannot grow while they are looked at
                none = pa.nulls(len(packed))
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(packed, pa.binary()), none.cast(pa.int32()), none.cast(pa.int64())], ["doc_id", "ids", "id", "n"])
        used = np.flatnonzero(counts)
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.binary()), pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], ["doc_id", "ids", "id", "n"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, TOKENIZED)


def write(tokenized: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Store what ``tokenize`` gives; it is read twice, so it should be a table."""
    spark = ship(tokenized.sparkSession)
    # at most a row for each id of the vocabulary
    ranked = [r.id for r in tokenized.where("n is not null").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "id").select("id").collect()]
    spark.createDataFrame(list(enumerate(ranked)), "number int, id int").coalesce(1).write.parquet(f"{path}/ids")
    number_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    number_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(number_of)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, begins = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, n = [], [], 0

        def row() -> pa.RecordBatch:
            control, data = encode_numbers(shared.value[np.concatenate(held)])
            values = [part, block, begins, n, doc_ids, [len(x) for x in held], control, data]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)], ["part", "block", "begins", "n", "doc_ids", "sizes", "control", "data"])

        for batch in batches:
            for doc_id, ids in rows_of(batch, "doc_id", "ids"):
                doc_ids.append(doc_id)
                held.append(_unpacked(ids))
                n += len(held[-1])
                if n >= block_ids:
                    yield row()
                    block, begins, doc_ids, held, n = block + 1, begins + n, [], [], 0
        if held:
            yield row()

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("ids").asc()]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = tokenized.where("ids is not null").select("doc_id", "ids").repartitionByRange(partitions, *order).sortWithinPartitions(*order, "ids")
    dealt.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    # a row a range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n").alias("n"))
    sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).coalesce(1).write.parquet(f"{path}/parts")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian unsigned 32-bit integers; start: ids of all documents before."""
    ids = spark.read.schema("number int, id int").parquet(f"{path}/ids").collect()
    id_of = np.zeros(len(ids), "<u4")
    for r in ids:
        id_of[r.number] = r.id
    shared = ship(spark).sparkContext.broadcast(id_of)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, begins, n, doc_ids, sizes, control, data in rows_of(batch, "base", "begins", "n", "doc_ids", "sizes", "control", "data"):
                flat = shared.value[decode_numbers(control, data, n)]
                ends = np.cumsum(sizes, dtype=np.int64)
                starts = ends - sizes
                texts = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(base + begins + starts, pa.int64()), pa.array(sizes, pa.int64()), texts], ["doc_id", "start", "n_tokens", "ids"])

    parts = spark.read.schema("part int, base long").parquet(f"{path}/parts")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").join(F.broadcast(parts), "part")
    return blocks.select("base", "begins", "n", "doc_ids", "sizes", "control", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op12_token_files(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        tokenized = materialize(tokenize(table(spark, sf_dir, "documents"), f.read()), "token-ids", "uncompressed")
    path = scratch_path(spark, "token-files")
    write(tokenized, path)
    discard_at_exit(spark, path)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
