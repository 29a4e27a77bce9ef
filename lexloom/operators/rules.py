"""User word lists: stems, and three ways in which a word can match.

For a handful of words ``in_rules`` is a Column expression. Lists of up to ``MAX_LISTED`` words go to the workers as sets
(``listed_flags``), which look at each distinct word of a batch once. For longer ones ``match_rules`` joins distinct words
with the lists on equal keys only. A word has a key for every way in which it could match, ten or so; a bitmap of the hashes of
all listed stems, of fixed size, lets few of them through that have no partner, so hardly more rows than words that match are joined.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.constants import ALL_ENDINGS, ANCHORS, DIPHTHONGS, EXCEPTION_PATTERNS, SAKHA_ENDINGS
from lexloom.errors import ValidationError
from lexloom.session import ship
from lexloom.sources.scratch import materialize

MIN_STEM = 2
MAX_EXCEPTIONS = 100_000  # patterns that the driver takes
MAX_LISTED = 200_000  # listed words that are sent to every worker
ROWS_AT_ONCE = 256  # whose words are looked up at a time
MAX_REST = 5  # a rest this short after a stem counts as an ending


def stems(word: Column) -> Column:
    """The lower-cased word, and what is left of it without each ending that it has."""
    low = F.lower(word)
    cut = [F.when(F.endswith(low, F.lit(e)) & (F.length(low) - len(e) >= MIN_STEM), F.substring(low, F.lit(1), F.length(low) - len(e))) for e in ALL_ENDINGS]
    return F.array_distinct(F.array_except(F.array(low, *cut), F.array(F.lit(None).cast("string"))))


def rule_tables(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word) of rules -> distinct lower-cased words, and all their stems."""
    words = rules.select(F.lower("word").alias("word")).distinct()
    return words, rules.select(F.explode(stems(F.col("word"))).alias("stem")).distinct()


def exact_matches(words: DataFrame, listed: DataFrame) -> DataFrame:
    """Words whose lower case is listed."""
    return words.join(listed.select(F.col("word").alias("_w")), F.lower("word") == F.col("_w"), "left_semi")


def stem_matches(words: DataFrame, listed_stems: DataFrame) -> DataFrame:
    """Words one of whose stems is a listed stem."""
    own = words.select("word", F.explode(stems(F.col("word"))).alias("stem"))
    return own.join(listed_stems, "stem", "left_semi").select("word").distinct()


EXACT, STEM, PREFIX = 1, 2, 3
WAYS = ("exact", "stem", "prefix")
BITMAP = 1 << 26  # bits


def stem_bitmap(listed_stems: DataFrame) -> np.ndarray:
    """A bit for the hash of each (stem): ``BITMAP`` / 8 bytes, however many stems there are."""
    bit = F.pmod(F.xxhash64("stem"), F.lit(BITMAP))
    parts = listed_stems.where("stem is not null").select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    out = np.zeros(BITMAP // 64, np.int64)
    for r in parts.collect():
        out[r["at"]] = r.bits
    return out.view(np.uint64)


def bitmap_flags(spark: SparkSession, bits: np.ndarray) -> Callable[[Column], Column]:
    """For an array of words' ``xxhash64``: which of them the bitmap lets through; none of a null array."""
    shared = ship(spark).sparkContext.broadcast(bits)

    @F.arrow_udf("array<boolean>")
    def flags(hashes: pa.Array) -> pa.Array:
        bit = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False) & (BITMAP - 1)
        hit = (shared.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
        ends = np.cumsum(pc.list_value_length(hashes).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(hit))

    return flags


def word_keys(low: str, ways: tuple[int, ...]) -> dict[str, int]:
    """The stems by which a lower-cased word would match, with the first way for each."""
    keys: dict[str, int] = {}
    if EXACT in ways:
        keys[low] = EXACT
    if STEM in ways:
        keys.setdefault(low, STEM)
        for e in ALL_ENDINGS:
            if low.endswith(e) and len(low) - len(e) >= MIN_STEM:
                keys.setdefault(low[: -len(e)], STEM)
    if PREFIX in ways:
        for cut in range(MIN_STEM, len(low) + 1):
            if len(low) - cut <= MAX_REST or low.startswith(SAKHA_ENDINGS, cut):
                keys.setdefault(low[:cut], PREFIX)
    return keys


def possible_keys(words: DataFrame, bits: np.ndarray, ways: tuple[int, ...] = (EXACT, STEM, PREFIX)) -> DataFrame:
    """(word) -> (word, stem, way): the keys that the bitmap lets through."""
    shared = ship(words.sparkSession).sparkContext.broadcast(bits)

    @F.arrow_udf("array<struct<stem:string,way:int>>")
    def keys(low: pa.Array) -> pa.Array:
        out = []
        for word in low.to_pylist():
            found = []
            for stem, way in word_keys(word, ways).items() if word is not None else ():
                bit = xxhash.xxh64_intdigest(stem.encode(), 42) % BITMAP  # as Spark hashes a string
                if int(shared.value[bit >> 6]) >> (bit & 63) & 1:
                    found.append({"stem": stem, "way": way})
            out.append(found)
        return pa.array(out, pa.list_(pa.struct([("stem", pa.string()), ("way", pa.int32())])))

    return words.select("word", F.explode(keys(F.lower("word"))).alias("key")).select("word", "key.*")


def prefix_matches(words: DataFrame, listed_stems: DataFrame) -> DataFrame:
    """Words that are a listed stem and a rest that is empty, short or starts with a Sakha ending."""
    keys = possible_keys(words, stem_bitmap(listed_stems), (PREFIX,))
    return keys.join(listed_stems, "stem", "left_semi").select("word").distinct()


def match_distinct(words: DataFrame, rules: DataFrame) -> DataFrame:
    """As ``match_rules``, for words that are distinct already."""
    stem = F.explode(stems(F.col("word"))).alias("stem")
    known = rules.where("word is not null").select("word", stem).groupBy("stem").agg(F.max(F.col("stem") == F.lower("word")).alias("listed"))
    known = materialize(known, "rules-stems")
    met = possible_keys(words, stem_bitmap(known)).join(known, "stem")
    way = F.when((F.col("way") == EXACT) & ~F.col("listed"), STEM).otherwise(F.col("way"))
    return met.groupBy("word").agg(F.min(way).alias("way")).select("word", F.element_at(F.array(*map(F.lit, WAYS)), F.col("way")).alias("way"))


def match_rules(words: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct words with which way they match: exact, stem or prefix, the first that holds."""
    return match_distinct(words.select("word").distinct(), rules)


def in_rules(word: Column, words: list[str]) -> Column:
    """The three rules for a short list, within an expression."""
    low = F.lower(word)
    listed = sorted({w.lower() for w in words})
    listed_stems = sorted(set(listed) | {w[: -len(e)] for w in listed for e in ALL_ENDINGS if w.endswith(e) and len(w) - len(e) >= MIN_STEM})
    if not listed:
        return F.lit(False)
    known = F.array(*map(F.lit, listed_stems))
    ending = f"^(?:{'|'.join(SAKHA_ENDINGS)})"
    by_prefix = F.exists(known, lambda s: F.startswith(low, s) & (F.length(s) >= MIN_STEM) & ((F.length(low) - F.length(s) <= MAX_REST) | F.rlike(F.substring(low, F.length(s) + 1, F.lit(1 << 20)), F.lit(ending))))
    return low.isin(*listed) | F.arrays_overlap(stems(word), known) | by_prefix


class ListedWords:
    """The three rules over sets in memory."""

    def __init__(self, words: list[str]):
        self.words = {w.lower() for w in words}
        self.stems = self.words | {w[: -len(e)] for w in self.words for e in ALL_ENDINGS if w.endswith(e) and len(w) - len(e) >= MIN_STEM}

    def __contains__(self, word: str) -> bool:
        low = word.lower()
        if low in self.words or low in self.stems or any(low.endswith(e) and len(low) - len(e) >= MIN_STEM and low[: -len(e)] in self.stems for e in ALL_ENDINGS):
            return True
        return any(low[:cut] in self.stems and (len(low) - cut <= MAX_REST or low.startswith(SAKHA_ENDINGS, cut)) for cut in range(MIN_STEM, len(low)))


def small_list(rules: DataFrame) -> list[str] | None:
    """The listed words, if they are few enough to be sent to every worker."""
    found = rules.select(F.lower("word").alias("word")).where("word is not null").distinct().limit(MAX_LISTED + 1).collect()
    return [r.word for r in found] if len(found) <= MAX_LISTED else None


def listed_flags(spark: SparkSession, words: list[str]) -> Callable[[Column], Column]:
    """A function from tokens (array<string>) to which of them the lists delete: those that match and are not plainly Sakha."""
    shared = spark.sparkContext.broadcast(ListedWords(words))
    decided: dict[str, bool] = {}

    def listed(word: str | None) -> bool:
        if word is None:
            return False
        known = decided.get(word)
        if known is None:
            if len(decided) >= 200_000:
                decided.clear()
            sakha = any(c in word for c in ANCHORS) or any(d in word for d in DIPHTHONGS)
            known = decided[word] = not sakha and word in shared.value
        return known

    def of_rows(tokens: pa.Array) -> pa.Array:
        coded = tokens.flatten().dictionary_encode()
        each = np.array([listed(w) for w in coded.dictionary.to_pylist()], bool)
        values = each[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, bool)
        sizes = pa.compute.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(values, pa.bool_()))

    @F.arrow_udf("array<boolean>")
    def flags(tokens: pa.Array) -> pa.Array:
        # a batch may hold many long texts: the words of few rows stand as Python strings at a time
        parts = [of_rows(tokens.slice(at, ROWS_AT_ONCE)) for at in range(0, len(tokens), ROWS_AT_ONCE)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.bool_()))

    return flags


def read_word_list(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """(word): the lines of all matching files of a folder, or of one file; blank ones and # comments are skipped.

    A folder that does not exist has no words, which is told; files that cannot be read are left out.
    """
    if pattern and "://" not in path and not os.path.isdir(path):
        logging.warning("no folder of word lists: %s", path)
        return spark.createDataFrame([], "word string")
    lines = spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).text(path) if pattern else spark.read.text(path)
    word = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    return lines.select(word.alias("word")).where("word <> '' and not startswith(word, '#')")


def read_exceptions(spark: SparkSession, path: str | None) -> tuple[str, ...]:
    """The built-in exception patterns and those of a file; a pattern list is a setting, so it is read on the driver."""
    if path is None:
        return EXCEPTION_PATTERNS
    found = [r.word for r in read_word_list(spark, path, "").limit(MAX_EXCEPTIONS + 1).collect()]
    if len(found) > MAX_EXCEPTIONS:
        raise ValidationError(f"{path} holds more than {MAX_EXCEPTIONS} patterns")
    return (*EXCEPTION_PATTERNS, *found)
