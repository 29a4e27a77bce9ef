"""Words that no rule decides, looked up in dictionaries of base forms by a paradigm join.

A dictionary is a table (base, language). A base form and a word of a text belong together if they are equal, or if they
are equal when each is stripped of at most one ending of the language. Both sides send a row for every way to strip
them, so the join is on equal (language, stem), whatever the size of the dictionary, and each distinct word is looked up
once. An equal base form (layer ``base``) counts before an inflected one (``form``); where two languages are equally near,
the one that is not to be deleted counts.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.config import DEFAULT, Config
from lexloom.constants import RUSSIAN_ENDINGS, SAKHA_ENDINGS
from lexloom.operators.rules import MIN_STEM, read_word_list
from lexloom.sources.storage import Storage

#: Endings by language; a language without a paradigm is looked up by base forms alone.
PARADIGMS = {"ru": RUSSIAN_ENDINGS, "sah": SAKHA_ENDINGS}
LAYERS = ("base", "form")


def paradigm_stems(low: Column, endings: tuple[str, ...]) -> Column:
    """A lower-cased word, and what is left of it without each ending that it has."""
    cut = [F.when(F.endswith(low, F.lit(e)) & (F.length(low) - len(e) >= MIN_STEM), F.substring(low, F.lit(1), F.length(low) - len(e))) for e in endings]
    return F.array_distinct(F.filter(F.array(low, *cut), lambda s: s.isNotNull()))


def _keys(words: DataFrame, word: str, language: Column, paradigms: dict[str, tuple[str, ...]]) -> DataFrame:
    """(word, language, stem, whole) for every way to strip a word; words have a language of their own, or get each one."""
    low = F.lower(word)
    stems = F.array(low)
    for name, endings in paradigms.items():
        stems = F.when(language == name, paradigm_stems(low, endings)).otherwise(stems)
    stripped = words.where(F.col(word).isNotNull()).select(F.col(word).alias("word"), language.alias("language"), F.explode(stems).alias("stem"))
    return stripped.select("word", "language", "stem", (F.col("stem") == F.lower("word")).alias("whole"))


def look_up(words: DataFrame, dictionary: DataFrame, primary: str = DEFAULT.primary_language, paradigms: dict[str, tuple[str, ...]] = PARADIGMS) -> DataFrame:
    """Distinct (word) -> (word, language, layer) of the words that a dictionary knows."""
    known = _keys(dictionary, "base", F.col("language"), paradigms).groupBy("language", "stem").agg(F.max("whole").alias("base"))
    languages = sorted({*paradigms, *(r.language for r in dictionary.select("language").where("language is not null").distinct().collect())})  # a few
    each = words.select("word", F.explode(F.array(*map(F.lit, languages))).alias("language")) if languages else words.select("word", F.lit("").alias("language"))
    met = _keys(each, "word", F.col("language"), paradigms).join(known, ["language", "stem"])
    found = met.select("word", "language", F.when(F.col("whole") & F.col("base"), 0).otherwise(1).alias("rank"))
    nearest = found.groupBy("word").agg(F.min(F.struct("rank", (F.col("language") == primary).alias("deleted"), "language")).alias("at"))
    return nearest.select("word", "at.language", F.element_at(F.array(*map(F.lit, LAYERS)), F.col("at.rank") + 1).alias("layer"))


def read_dictionaries(spark: SparkSession, config: Config = DEFAULT) -> DataFrame | None:
    """(base, language) of the configured folder, whose files are named by their language (``ru.txt``); None where there are none."""
    if config.dictionary_folder is None:
        return None
    out = None
    for file in Storage(spark).files(Storage(spark).check_folder(config.dictionary_folder), ".txt"):
        language = os.path.basename(file.file).removesuffix(".txt")
        bases = read_word_list(spark, file.file, "").select(F.col("word").alias("base"), F.lit(language).alias("language"))
        out = bases if out is None else out.unionByName(bases)
    return out
