"""LM scoring by the marginal likelihood of a subword lattice.

A word's probability is the sum over all its segmentations into pieces of an existing vocabulary, by a forward
recursion in log space. The vocabulary's own scores give the first piece weights (Zipf's law over their order); one
round of expectation over the training words, each distinct word once and weighted by its count, refits them. The
lattice has one more arc, which spans a whole word seen in training with its relative frequency, and whose share is
one minus the training words' share of words seen once. Characters outside the vocabulary fall back to byte pieces.

The recursion runs over all words of a batch at once, a step for each character, on arcs that a walk down the vocabulary's
trie finds from every character at once.

Word counts, expectations and word scores come from the shuffle of distinct words in ``wordblocks``: one task sees all
counts of a word, and what is gathered for a bucket grows with the corpus' vocabulary. Only sums over the vocabulary's
pieces (a fixed number) reach the driver.

Cases: a null text counts as empty, and is the end token only; without training rows N and V are 0 and every base
score is 0; a null id is a training row; texts and words of any length are scored whole, a long word in as many steps as it
has characters; words are bytes, and those that are no UTF-8 fall back to bytes; equal rows
score alike; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, mix64, release, rows_of
from lexloom.llm.wordblocks import Block, Bucket, back_to_blocks, by_bucket, cut_blocks, doc_starts, pack, per_bucket, unpack

VOCABULARY = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 5, 1
PRIOR = 2000.0  # occurrences that the vocabulary's own weights count for
FIXED = 1 << 16  # expectations are summed as whole multiples of 1/FIXED, in any order alike
AT_ONCE = 1 << 16  # bytes of words in one lattice, unless one word is longer
MERGERS = 16  # tasks that add up the buckets' expectations
_START = "▁"  # the vocabulary's mark of a word's start
_DISTINCT, _ONCE = -1, -2  # keys of the sums that are no pieces


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def split_words(block: Block, raw: bytes) -> np.ndarray:
    words = raw.lower().split()
    number = block.number
    return np.fromiter(map(number, words), np.uint32, len(words))


class Pieces:
    """The vocabulary: pieces, their numbers, and the first weights, from the order of its scores.

    Its trie is kept by levels: per length, the sorted hashes of all pieces' beginnings of that length, and for each which
    piece it is, or -1.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i))]
        usable.sort(key=lambda i: (-model.get_score(i), i))
        self.names = [model.id_to_piece(i) for i in usable]
        weights = 1.0 / (np.arange(len(usable)) + 10.0)
        byte = np.array([model.is_byte(i) for i in usable])
        weights[byte] = weights.min()
        self.first = weights / weights.sum()
        self.bytes = [0] * 256
        for n in np.flatnonzero(byte):
            self.bytes[int(self.names[n][3:5], 16)] = int(n)
        self.numbers = {name: n for n, name in enumerate(self.names) if not byte[n]}
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for length in range(1, max(map(len, self.numbers)) + 1):
            beginnings = sorted({name[:length] for name in self.numbers if len(name) >= length})
            hashes = _START_HASH
            chars = np.frombuffer("".join(beginnings).encode("utf-32-le"), "<u4").reshape(-1, length)
            for at in range(length):
                hashes = _extend(hashes, chars[:, at])
            order = np.argsort(hashes)
            if len(np.unique(hashes)) != len(hashes):
                raise ValueError("two beginnings of pieces share a hash")
            self.levels.append((hashes[order], np.array([self.numbers.get(beginnings[i], -1) for i in order], np.int64)))

    def fallback(self, char: int) -> list[int]:
        """The byte pieces of a character outside the vocabulary."""
        return [self.bytes[b] for b in chr(char).encode("utf-8", "surrogateescape")]


_START_HASH = np.zeros(1, np.uint64)


def _extend(hashes: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Hashes of strings that are one character longer."""
    return mix64(hashes * np.uint64(0xD1342543DE82EF95) + chars.astype(np.uint64))


class Lattice:
    """All arcs of some words: where each starts, its length in characters and its piece (-1: the character's bytes).

    Words are ordered by length, longest first. A word of n characters has n + 1 places, numbered on from the word before.
    """

    def __init__(self, pieces: Pieces, words: list[bytes]):
        self.pieces = pieces
        texts = [_START + w.decode("utf-8", "surrogateescape") for w in words]
        lengths = np.array([len(t) for t in texts], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.sizes = lengths[self.order]
        chars = np.frombuffer("".join([texts[i] for i in self.order.tolist()]).encode("utf-32-le", "surrogatepass"), "<u4")
        word = np.repeat(np.arange(len(words)), self.sizes)
        ends = np.cumsum(self.sizes)
        self.first = ends - self.sizes + np.arange(len(words))  # each word's first place
        left = ends[word] - np.arange(len(chars))  # characters from here to the word's end
        place = np.arange(len(chars)) + word
        # walk down the trie from every character at once; those go on that are still the beginning of a piece
        starts, lengths_, found = [], [], []
        active, hashes = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        for depth, (known, piece) in enumerate(pieces.levels):
            inside = left[active] > depth
            active, hashes = active[inside], hashes[inside]
            if not len(active):
                break
            hashes = _extend(hashes, chars[active + depth])
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            met = known[at] == hashes
            names = np.where(met, piece[at], -1)
            arc = (names >= 0) | (depth == 0)
            starts.append(active[arc])
            lengths_.append(np.full(int(arc.sum()), depth + 1))
            found.append(names[arc])
            active, hashes = active[met], hashes[met]
        start = np.concatenate([np.zeros(0, np.int64), *starts])
        self.start, self.length, self.piece = place[start], np.concatenate([np.zeros(0, np.int64), *lengths_]), np.concatenate([np.zeros(0, np.int64), *found])
        self.longest = int(self.length.max(initial=1))
        self.bare, self.bare_of = np.unique(chars[start[self.piece < 0]], return_inverse=True)

    def weights(self, log_weight: np.ndarray) -> np.ndarray:
        """Every arc's log weight."""
        by_bytes = np.array([log_weight[self.pieces.fallback(c)].sum() for c in self.bare.tolist()])
        out = log_weight[self.piece]
        out[self.piece < 0] = by_bytes[self.bare_of]
        return out

    def _sums(self, weight: np.ndarray, backward: bool) -> np.ndarray:
        """For every place, the log of the summed weight of all ways to it (from it, if ``backward``)."""
        places = int(self.first[-1] + self.sizes[-1] + 1) if len(self.sizes) else 0
        table = np.full((self.longest, places), -np.inf)
        table[self.length - 1, self.start] = weight
        sums = np.zeros(places)
        for step in range(1, int(self.sizes.max(initial=0)) + 1):
            words = int(np.searchsorted(-self.sizes, -step, side="right"))  # those that are so long
            reach = np.arange(1, min(step, self.longest) + 1)[:, None]
            at = (self.first + self.sizes - step if backward else self.first + step)[:words][None, :]
            ways = table[reach - 1, at] + sums[at + reach] if backward else table[reach - 1, at - reach] + sums[at - reach]
            top = ways.max(axis=0)
            sums[at[0]] = top + np.log(np.exp(ways - top).sum(axis=0))
        return sums

    def _by_word(self, ordered: np.ndarray) -> np.ndarray:
        out = np.empty(len(ordered), ordered.dtype)
        out[self.order] = ordered
        return out

    def forward(self, log_weight: np.ndarray) -> np.ndarray:
        """Each word's log of the summed weight of all its segmentations."""
        return self._by_word(self._sums(self.weights(log_weight), False)[self.first + self.sizes])

    def expectations(self, log_weight: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Each piece's expected number of uses, the words occurring ``counts`` times."""
        weight = self.weights(log_weight)
        ahead, behind = self._sums(weight, False), self._sums(weight, True)
        word = np.searchsorted(self.first, self.start, side="right") - 1
        total = ahead[self.first + self.sizes]
        share = np.exp(ahead[self.start] + weight + behind[self.start + self.length] - total[word]) * counts[self.order][word]
        named = self.piece >= 0
        out = np.bincount(self.piece[named], weights=share[named], minlength=len(self.pieces.names))
        for char, uses in zip(self.bare.tolist(), np.bincount(self.bare_of, weights=share[~named]).tolist(), strict=True):
            for piece in self.pieces.fallback(char):
                out[piece] += uses
        return out


def batched(words: list[bytes], at_once: int) -> Iterator[np.ndarray]:
    """Numbers of words of like length that have about ``at_once`` bytes together, in an order that the words alone give."""
    order = sorted(range(len(words)), key=lambda i: (len(words[i]), words[i]))
    sizes = np.cumsum([len(words[i]) + 1 for i in order])
    cuts = np.searchsorted(sizes, np.arange(at_once, int(sizes[-1]) + at_once, at_once), side="right") if order else []
    begin = 0
    for end in cuts:
        end = max(int(end), begin + 1)
        if begin < len(order):
            yield np.array(order[begin:end], np.int64)
        begin = end
    if begin < len(order):
        yield np.array(order[begin:], np.int64)


def _expect(shared):
    state: dict = {}

    def run(table: pa.Table) -> pa.Table:
        if "pieces" not in state:
            state["pieces"] = shared.value
            state["log"] = np.log(state["pieces"].first)
        bucket, pieces = Bucket(table), state["pieces"]
        trained = np.flatnonzero(bucket.counts)
        words, counts = [bucket.words[i] for i in trained.tolist()], bucket.counts[trained]
        sums = np.zeros(len(pieces.names))
        for some in batched(words, AT_ONCE):
            sums += Lattice(pieces, [words[i] for i in some.tolist()]).expectations(state["log"], counts[some])
        used = np.flatnonzero(sums)
        keys, amounts = np.append(used, [_DISTINCT, _ONCE]), np.append(np.rint(sums[used] * FIXED).astype(np.int64), [len(trained), int((counts == 1).sum())])
        out = pa.table([pa.array([pack(keys, amounts)], pa.binary())], ["sums"])
        del bucket, words
        release()
        return out

    return run


@frugal
def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed sums of many buckets -> one; the task holds one number per piece."""
    total: Counter = Counter()
    for batch in batches:
        for (blob,) in rows_of(batch, "sums"):
            keys, amounts = unpack(blob)
            for key, amount in zip(keys.tolist(), amounts.tolist(), strict=True):
                total[key] += amount
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([pack(np.array(list(total.keys()), np.int64), np.array(list(total.values()), np.int64))], pa.binary())], ["sums"])


def lattice_scores(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per document."""
    context = docs.sparkSession.sparkContext
    pieces = Pieces(vocabulary)
    shared = context.broadcast(pieces)
    blocks = cut_blocks(docs, split_words, lambda d: not held_out(d), id_col, text_col)
    trained = blocks.select(F.explode(F.arrays_zip("flags", "n_words")).alias("d")).where("d.flags").agg(F.count("*").alias("docs"), F.coalesce(F.sum("d.n_words"), F.lit(0)).alias("words")).first()
    # a row per bucket, merged in MERGERS tasks, each of which sends one row with a number per piece at most
    sums = by_bucket(blocks).applyInArrow(_expect(shared), "sums binary").repartition(MERGERS).mapInArrow(_merge, "sums binary")
    got: Counter = Counter()
    for row in sums.collect():
        for key, amount in zip(*(a.tolist() for a in unpack(row.sums)), strict=True):
            got[key] += amount
    n_train = trained.words + trained.docs
    distinct = got.pop(_DISTINCT, 0) + (trained.docs > 0)
    once = got.pop(_ONCE, 0)
    uses = np.zeros(len(pieces.first))
    uses[list(got)] = np.array(list(got.values()), float) / FIXED
    weights = (uses + PRIOR * pieces.first) / (uses.sum() + PRIOR)
    known = min(0.95, max(0.05, 1 - once / trained.words)) if trained.words else 0.05
    model = context.broadcast((np.log(weights), known, trained.words))
    state: dict = {}

    def handle(bucket: Bucket):
        if "log" not in state:
            state["log"], state["known"], state["words"] = model.value
            state["pieces"] = shared.value
        log_weight, share, words, vocabulary_ = state["log"], state["known"], state["words"], state["pieces"]
        found = np.zeros(len(bucket.words))
        for some in batched(bucket.words, AT_ONCE):
            found[some] = Lattice(vocabulary_, [bucket.words[i] for i in some.tolist()]).forward(log_weight) + math.log(1 - share)
        seen = np.flatnonzero(bucket.counts)
        # the arc over the whole word
        found[seen] = np.logaddexp(found[seen], np.log(share * bucket.counts[seen] / max(words, 1)))
        found /= math.log(10)
        return lambda here: pack(bucket.counts[here], found[here])

    down = n_train + 0.5 * (distinct + 1)
    end = math.log10((trained.docs + 0.5) / down)

    def finish(row: dict, found: list[tuple[np.ndarray, bytes]]) -> pa.Table:
        numbers = row["numbers"]
        parts = [(ranks, *unpack(blob)) for ranks, blob in found]
        n = sum(len(p[0]) for p in parts)
        counts, scores = np.full(n, -1, np.int64), np.zeros(n)
        for ranks, c, s in parts:
            counts[ranks], scores[ranks] = c, s
        if n and counts.min() < 0:
            raise RuntimeError("a block lacks words that it uses")
        base = np.log10((counts + 0.5) / down)
        starts = doc_starts(row)
        total = lambda per_word: np.diff(np.concatenate([[0], np.cumsum(per_word)])[starts])
        sums = [np.array([x[numbers[a:b]].sum() for a, b in zip(starts[:-1], starts[1:], strict=True)]) for x in (base, scores)]
        rows = len(row["doc_ids"])
        return pa.table(
            [pa.array(row["doc_ids"], pa.int64()), pa.array([not f for f in row["flags"]], pa.bool_()), pa.array(np.array(row["n_words"], np.int64) + 1), pa.array(total((counts[numbers] > 0).astype(np.int64)) + int(trained.docs > 0)), pa.array([n_train] * rows, pa.int64()), pa.array(sums[0] + end), pa.array(sums[1] + end)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return back_to_blocks(blocks, per_bucket(blocks, handle), finish, schema)


def op8_lattice_lm(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    return lattice_scores(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
