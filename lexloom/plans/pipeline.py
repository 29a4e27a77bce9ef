"""The cleaning pipeline, per document: strip, heal, drop what is no word, drop Russian words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexloom.config import DEFAULT, Config
from lexloom.functions import classify, healing, text, tokens
from lexloom.operators import dictionary as D
from lexloom.operators import rules as R
from lexloom.operators.stats import best_attempt
from lexloom.session import ship
from lexloom.sources import files
from lexloom.sources.scratch import materialize
from lexloom.sources.storage import Storage


def clean_text(column: Column, config: Config = DEFAULT) -> Column:
    """The whole pipeline as one expression; only healing leaves the JVM."""
    return classify.remove_russian_words(tokens.filter_invalid_words(healing.heal_text(text.remove_special(column), config)), config)


def clean(docs: DataFrame, config: Config = DEFAULT, text_col: str = "text") -> DataFrame:
    """docs with ``text_col`` cleaned."""
    ship(docs.sparkSession)
    return docs.withColumn(text_col, clean_text(F.col(text_col), config))


def undecided_words(docs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Distinct words that no rule decides."""
    words = docs.select(F.explode(tokens.joined_tokens(F.col("text"))).alias("word")).distinct()
    return words.where(classify.deciding_rule(F.col("word"), config) == "undecided")


def detect_words(words: DataFrame, detect) -> DataFrame:
    """(word) -> the words that ``detect`` accepts; each distinct word is looked at once, in Arrow batches."""
    ship(words.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[batch["word"].map(detect).astype(bool)]

    return words.select("word").mapInPandas(run, "word string")


_ROW, _POS, _WORD, _TOKENS, _FLAGS = ("__lexloom_row", "__lexloom_pos", "__lexloom_word", "__lexloom_tokens", "__lexloom_flags")
_GONE, _KEPT_WORDS, _COUNT = ("__lexloom_gone", "__lexloom_kept_words", "__lexloom_count")
_HEALED, _DOTTED, _DROPPED, _KEPT = ("__lexloom_healed", "__lexloom_dotted", "__lexloom_dropped", "__lexloom_kept")

#: What a run counts: runs of spaced letters, tokens by the rule that drops them, and words that the cascade keeps and deletes.
COUNTERS = ("spaced_letters", *(name for name, _ in tokens.DROP_RULES), "kept", "removed")


def numbered(docs: DataFrame, tag: str) -> DataFrame:
    """docs in the shared folder, each row with a number of its own."""
    return materialize(docs.withColumn(_ROW, F.monotonically_increasing_id()), tag)


def remove_words(rows: DataFrame, deleted: DataFrame, text_col: str = "text", kept_col: str | None = None, config: Config = DEFAULT) -> DataFrame:
    """``numbered`` rows, without their numbers and without the words of ``deleted`` (word) and those deleted by form.

    For lists that are too long for the workers. Texts stay in their rows, so ids may repeat or be null. Words are deleted by
    form where they lie; of the others only occurrences that a bitmap of the listed words lets through are looked up, and
    positions return to the row. A text that is null comes out empty. ``kept_col`` is a new column with the number of words
    that are left.
    """
    listed = deleted.where(~classify.deleted_by_form(F.col("word"), config)).select(F.col("word").alias(_WORD)).distinct()
    listed = materialize(listed, "removed-words")
    flags = R.bitmap_flags(ship(rows.sparkSession), R.stem_bitmap(listed.select(F.col(_WORD).alias("stem"))))
    words = tokens.joined_tokens(F.col(text_col))
    hashed = rows.select(_ROW, words.alias(_TOKENS)).withColumn(_FLAGS, flags(F.transform(_TOKENS, lambda w: F.xxhash64(w))))
    possible = F.transform(_TOKENS, lambda w, i: F.when(F.get(F.col(_FLAGS), i), F.struct(i.alias(_POS), w.alias(_WORD))))
    asked = hashed.select(_ROW, F.explode(F.filter(possible, lambda x: x.isNotNull())).alias("at")).select(_ROW, "at.*")
    gone = asked.join(listed, _WORD, "left_semi").groupBy(_ROW).agg(F.collect_list(_POS).alias(_GONE))
    met = rows.join(gone, _ROW, "left").withColumn(_TOKENS, words)
    # by positions, as their difference is taken by hashing
    places = F.array_except(F.transform(_TOKENS, lambda w, i: i), F.coalesce(_GONE, F.array().cast("array<int>")))
    kept = F.filter(F.transform(places, lambda i: F.get(F.col(_TOKENS), i)), lambda w: ~classify.deleted_by_form(w, config))
    out = met.withColumn(_KEPT_WORDS, kept)
    out = out.withColumn(text_col, F.coalesce(F.array_join(F.transform(_KEPT_WORDS, classify.spaced_out), " "), F.lit("")))
    more = [F.when(F.col(_KEPT_WORDS).isNull(), 0).otherwise(F.size(_KEPT_WORDS)).alias(kept_col)] if kept_col else []
    return out.select(*(c for c in rows.columns if c != _ROW), *more)


def listed_kept(docs: DataFrame, listed: list[str], config: Config = DEFAULT, text_col: str = "text") -> DataFrame:
    """docs with the arrays of all words and of those that are neither Russian nor listed, decided within each row: no shuffle."""
    flags = R.listed_flags(ship(docs.sparkSession), listed)
    flagged = docs.withColumn(_TOKENS, tokens.joined_tokens(F.col(text_col))).withColumn(_FLAGS, flags(F.col(_TOKENS)))
    return flagged.withColumn(_KEPT, F.filter(_TOKENS, lambda w, i: ~(F.get(F.col(_FLAGS), i) | classify.deleted_by_form(w, config))))


def remove_listed(docs: DataFrame, listed: list[str], config: Config = DEFAULT, text_col: str = "text") -> DataFrame:
    """docs without Russian words and without listed ones."""
    kept = F.array_join(F.transform(_KEPT, classify.spaced_out), " ")
    return listed_kept(docs, listed, config, text_col).withColumn(text_col, F.coalesce(kept, F.lit(""))).select(*docs.columns)


def decided_words(words: DataFrame, rules: DataFrame | None = None, config: Config = DEFAULT, dictionary: DataFrame | None = None) -> DataFrame:
    """Distinct (word) -> (word, rule): which step of the cascade decides it.

    Words that no rule decides are looked up in the dictionary; ``dictionary`` says that one of the primary language
    knows the word and ``dictionary_other`` that another one does.
    """
    matched = R.match_distinct(words, rules) if rules is not None else words.limit(0).withColumn("way", F.lit(""))
    decided = words.join(matched, "word", "left").select("word", classify.deciding_rule(F.col("word"), config, F.col("way").isNotNull()).alias("rule"))
    if dictionary is None:
        return decided
    decided = materialize(decided, "decided-words")
    known = D.look_up(decided.where("rule = 'undecided'"), dictionary, config.primary_language)
    found = F.when(F.col("language") == config.primary_language, "dictionary").when(F.col("language").isNotNull(), "dictionary_other").otherwise(F.col("rule"))
    return decided.join(known, "word", "left").select("word", found.alias("rule"))


def deleted_words(valid: DataFrame, rules: DataFrame | None, config: Config, detect, text_col: str, dictionary: DataFrame | None = None) -> DataFrame:
    """(word): the distinct words that the cascade deletes, each classified once."""
    words = materialize(valid.select(F.explode(tokens.joined_tokens(F.col(text_col))).alias("word")).distinct(), "clean-words")
    decided = decided_words(words, rules, config, dictionary)
    deleted = decided.where(F.col("rule").isin(*classify.DELETING)).select("word")
    return deleted if detect is None else deleted.unionByName(detect_words(decided.where("rule = 'undecided'"), detect))


def clean_with_rules(docs: DataFrame, rules: DataFrame | None = None, config: Config = DEFAULT, detect=None, text_col: str = "text", dictionary: DataFrame | None = None) -> DataFrame:
    """``clean`` with user word lists (word) and, for words that no rule decides, a dictionary (base, language) and then a
    detector. A null text comes out empty.

    Word lists are settings: up to ``rules.MAX_LISTED`` words they are sent to the workers, and each row is cleaned where it
    lies. With longer lists, a dictionary or a detector, distinct words are classified once and joined back.
    """
    if rules is None and detect is None and dictionary is None:
        return clean(docs, config, text_col)
    ship(docs.sparkSession)
    valid = docs.withColumn(text_col, tokens.filter_invalid_words(healing.heal_text(text.remove_special(F.col(text_col)), config)))
    if detect is None and dictionary is None and (listed := R.small_list(rules)) is not None:
        return remove_listed(valid, listed, config, text_col)
    valid = numbered(valid, "clean-valid")  # read more than once, so that texts are healed once
    return remove_words(valid, deleted_words(valid, rules, config, detect, text_col, dictionary), text_col, config=config)


def _equal_to(array: str, value: str) -> Column:
    return F.filter(array, lambda x: x == value)


def clean_counted(docs: DataFrame, rules: DataFrame | None = None, config: Config = DEFAULT, detect=None, text_col: str = "text", counts_col: str = "counts", dictionary: DataFrame | None = None) -> DataFrame:
    """``clean_with_rules`` with one more column: a struct of ``COUNTERS`` for each row. A null text counts nothing."""
    ship(docs.sparkSession)
    column = F.col(text_col)
    healed = docs.withColumn(_HEALED, healing.heal_text(text.remove_special(column), config))
    dotted = healed.withColumn(_DOTTED, tokens.dot_tokens(text.drop_spaced_letters(F.col(_HEALED))))
    dropped = dotted.withColumn(_DROPPED, F.transform(F.filter(_DOTTED, lambda w: F.rlike(w, F.lit(tokens.DROPPED))), tokens.drop_reason))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    size = lambda c: F.when(c.isNotNull(), F.size(c))
    by_rule = [count(size(_equal_to(_DROPPED, name))).alias(name) for name, _ in tokens.DROP_RULES]
    first = F.struct(count(text.count_spaced_letters(F.col(_HEALED))).alias("spaced_letters"), *by_rule)
    others = [F.col(c) for c in docs.columns if c != text_col]
    left = F.array_join(F.filter(_DOTTED, lambda w: ~F.rlike(w, F.lit(tokens.DROPPED))), " ")
    valid = dropped.select(*others, left.alias(text_col), first.alias(_DROPPED))
    in_joins = detect is not None or dictionary is not None
    listed = None if rules is None or in_joins else R.small_list(rules)
    words = size(tokens.joined_tokens(column))
    if (rules is None or listed is not None) and not in_joins:
        kept = listed_kept(valid, listed, config, text_col) if listed else valid.withColumn(_TOKENS, tokens.joined_tokens(column)).withColumn(_KEPT, F.filter(_TOKENS, lambda w: ~classify.deleted_by_form(w, config)))
        out, words, n_kept = kept.withColumn(text_col, F.coalesce(F.array_join(F.transform(_KEPT, classify.spaced_out), " "), F.lit(""))), size(F.col(_TOKENS)), size(F.col(_KEPT))
    else:
        valid = numbered(valid.withColumn(_COUNT, words), "clean-valid")
        out, words, n_kept = remove_words(valid, deleted_words(valid, rules, config, detect, text_col, dictionary), text_col, _KEPT, config), F.col(_COUNT), F.col(_KEPT)
    counts = F.struct(F.col(f"{_DROPPED}.*"), count(n_kept).alias("kept"), count(words - n_kept).alias("removed"))
    return out.select(*docs.columns, counts.alias(counts_col))


def observed(counted: DataFrame, counts_col: str = "counts") -> tuple[DataFrame, Observation]:
    """The rows without their counters, and an observation of the counters' sums in the pass that writes the rows."""
    seen = Observation(f"counters-{uuid.uuid4().hex}")
    sums = [F.coalesce(F.sum(f"{counts_col}.{name}"), F.lit(0)).cast("long").alias(name) for name in COUNTERS]
    return counted.observe(seen, *sums).drop(counts_col), seen


def exception_patterns(spark: SparkSession, config: Config = DEFAULT) -> tuple[str, ...]:
    """The built-in exceptions and those of the configured file, for ``scalar.matches_exception``. Cleaning does not ask."""
    return R.read_exceptions(spark, config.word_healer_exceptions_file)


def word_lists(spark: SparkSession, config: Config = DEFAULT) -> DataFrame | None:
    """(word) of the lists in the folder for them; None where there are none."""
    folder = Storage(spark).full_name(config.additional_folder)
    found = Storage(spark).exists(folder) and Storage(spark).files(folder, ".txt")
    return R.read_word_list(spark, folder) if found else None


def clean_rows(rows: DataFrame, config: Config = DEFAULT, detect=None) -> DataFrame:
    """``clean`` with the word lists and dictionaries of the configured folders and, if given, a detector; the other columns stay."""
    return clean_with_rules(rows, word_lists(rows.sparkSession, config), config, detect, dictionary=D.read_dictionaries(rows.sparkSession, config))


def pdf_texts(pages: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(file, page, level, text, error) of ``read_pdf_pages`` -> (file, page, text, warning): the best attempt, hyphens merged."""
    attempts = pages.where("error is null").select(F.struct("file", "page").alias("page"), "level", "text")
    if not config.pdf_adaptive_tolerance:  # only the default level counts
        attempts = attempts.where(F.col("level") == files.DEFAULT_LEVEL)
    best = best_attempt(attempts, config.pdf_badness_threshold if config.pdf_adaptive_tolerance else 1.0, files.DEFAULT_LEVEL)
    return best.select("page.file", "page.page", text.merge_line_hyphens(F.coalesce("text", F.lit(""))).alias("text"), "warning")


def run(spark: SparkSession, config: Config = DEFAULT, extractor: files.PdfExtractor = files.extract_pages, detect=None) -> dict[str, str]:
    """Extract every PDF and Parquet file of the input folder, clean (with word lists), write, and archive; the run's paths.

    See ``runs``, where the steps of a run and what a crash leaves are told.
    """
    from lexloom.plans import runs

    return runs.run(spark, config, extractor, detect)
