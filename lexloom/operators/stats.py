"""Counts over documents and tokens, and the choice among extraction attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import classify, tokens
from lexloom.functions.text import badness, count_spaced_letters, drop_spaced_letters


def removal_counts(docs: DataFrame) -> DataFrame:
    """(reason, n): dropped tokens by the rule that dropped them, and runs of spaced letters."""
    token = docs.select(F.explode(tokens.dot_tokens(drop_spaced_letters(F.col("text")))).alias("token"))
    by_rule = token.select(tokens.drop_reason(F.col("token")).alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    spaced = docs.agg(F.coalesce(F.sum(count_spaced_letters(F.col("text"))), F.lit(0)).cast("long").alias("n")).select(F.lit("spaced_letters").alias("reason"), "n")
    return by_rule.unionByName(spaced)


def kept_and_removed(docs: DataFrame) -> DataFrame:
    """(kept, removed): words that the language cascade keeps and deletes."""
    counted = docs.select(F.size(tokens.joined_tokens(F.col("text"))).alias("all"), F.size(classify.kept_tokens(F.col("text"))).alias("kept"))
    return counted.agg(F.coalesce(F.sum("kept"), F.lit(0)).cast("long").alias("kept"), F.coalesce(F.sum(F.col("all") - F.col("kept")), F.lit(0)).cast("long").alias("removed"))


def removed_sample(docs: DataFrame, size: int = 20) -> DataFrame:
    """The first ``size`` deleted words of every document, in text order."""
    gone = F.filter(tokens.joined_tokens(F.col("text")), lambda w: classify.is_russian(w))
    return docs.select("doc_id", F.array_join(F.slice(gone, 1, size), " ").alias("sample"), F.size(gone).cast("long").alias("removed"))


def removed_words(docs: DataFrame, size: int) -> list[str]:
    """Some ``size`` of the words that the language cascade deletes, for a log."""
    gone = docs.select(F.explode(F.filter(tokens.joined_tokens(F.col("text")), lambda w: classify.is_russian(w))).alias("word"))
    return [r.word for r in gone.limit(size).collect()]


FALLBACK_WARNING = "no tolerance level was acceptable, the default one is used"


def best_attempt(attempts: DataFrame, threshold: float = 0.3, default_level: int = 1) -> DataFrame:
    """(page, level, text) -> one row a page, with a warning or null.

    The first level within the badness threshold is taken, else the least bad one. Empty and wholly bad attempts are no
    candidates; a page that has no others gets the default level's text (or the first level's) and a warning.
    """
    scored = attempts.withColumn("score", badness(F.col("text")))
    candidate = (F.col("text") != "") & ((F.col("score") < 1) | (F.col("score") <= threshold))
    late = F.col("score") > threshold
    rank = F.struct(late.alias("late"), F.when(late, F.col("score")).otherwise(F.lit(0.0)).alias("score"), F.col("level").alias("level"))
    attempt = F.struct("level", "text")
    chosen = scored.groupBy("page").agg(
        F.min_by(attempt, F.when(candidate, rank)).alias("best"), F.min_by(attempt, F.struct((F.col("level") != default_level).alias("other"), F.col("level").alias("level"))).alias("fallback")
    )
    taken = F.coalesce("best", "fallback")
    return chosen.select("page", taken["level"].alias("level"), taken["text"].alias("text"), F.when(F.col("best").isNull(), FALLBACK_WARNING).alias("warning"))


def best_in_row(attempts: Column, threshold: float = 0.3, default_level: int = 1) -> Column:
    """``best_attempt`` where a page's attempts are one array of (level, text): (level, text, warning), without a shuffle."""
    scored = F.transform(attempts, lambda a: F.struct(a["level"].alias("level"), a["text"].alias("text"), badness(a["text"]).alias("score")))
    usable = F.filter(scored, lambda a: (a["text"] != "") & ((a["score"] < 1) | (a["score"] <= threshold)))
    ranked = F.transform(usable, lambda a: F.struct((a["score"] > threshold).alias("late"), F.when(a["score"] > threshold, a["score"]).otherwise(F.lit(0.0)).alias("score"), a["level"].alias("level"), a["text"].alias("text")))
    best = F.array_min(ranked)
    fallback = F.array_min(F.transform(attempts, lambda a: F.struct((a["level"] != default_level).alias("other"), a["level"].alias("level"), a["text"].alias("text"))))
    # bound as a variable, since each of the struct's fields would choose anew
    chosen = lambda b: F.struct(F.coalesce(b["level"], fallback["level"]).alias("level"), F.coalesce(b["text"], fallback["text"]).alias("text"), F.when(b.isNull(), FALLBACK_WARNING).alias("warning"))
    return F.get(F.transform(F.array(best), lambda b: chosen(b)), F.lit(0))


def corpus_stats(docs: DataFrame) -> DataFrame:
    """(n_rows, n_chars, n_words, n_bytes) of a table of texts."""
    t = F.col("text")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return docs.agg(F.count("*").alias("n_rows"), total(F.length(t)).alias("n_chars"), total(tokens.count_words(t)).alias("n_words"), total(F.octet_length(t)).alias("n_bytes"))


def warning_counts(warnings: DataFrame) -> DataFrame:
    """(message, n)."""
    return warnings.groupBy("message").agg(F.count("*").alias("n"))


def merge_corpus(docs: DataFrame, separator: str = "\n") -> DataFrame:
    """One row per group with its texts joined in order: for small groups, such as the pages of a file."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return docs.groupBy("doc").agg(F.array_join(ordered["text"], separator).alias("text"))
