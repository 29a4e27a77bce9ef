"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

Cases, stage by stage. Null, empty and blank texts score the labelled rows' mean and stay if that is good; line dedup, which
drops documents that it leaves without a line, never drops those that had none before, and near-dup links them with nothing;
mixing draws no document without words. Of rows that are equal in id and text one keeps its lines, so the other goes, unless
they are blank. Null ids are ordinary rows: they come last where the first row stays. Null sources are one source. Texts of
any length are taken whole. Extra columns, whatever their names, pass through all stages but the last. An empty table gives
an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import bpe, line_dedup, mixing, near_dup, quality_knn
from lexloom.llm.common import table
from lexloom.sources.scratch import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled neighbours vote good."""
    model = quality_knn.fit(docs, table(spark, sf_dir, "labels"))
    numbered = [f"c{i}" for i in range(len(docs.columns))]  # a column of docs may be called like the score
    scored = quality_knn.score_documents(docs, model, keep=tuple(docs.columns)).toDF(*numbered, "score")
    return scored.where(F.col("score") >= quality_knn.THRESHOLD).select(*numbered).toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of every group of near-equal lines; documents without a line of their own go."""
    out = line_dedup.dedup_lines(docs, drop_empty=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked at 0.8 similarity of five-word shingles: the one with the smallest id, if any has one.

    Rows have keys of their own, so that rows with equal ids or without one are told apart.
    """
    number = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = materialize(docs.toDF(*number.values()).withColumn("row", F.monotonically_increasing_id()), "near-dup-rows")
    placed = near_dup.near_duplicates(rows, id_col="row", text_col=number["text"]).select(F.col("doc_id").alias("row"), "component_id")
    named = placed.join(rows.select("row", F.col(number["doc_id"]).alias("id")), "row")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row"))
    kept = named.groupBy("component_id").agg(first.alias("first")).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*number.values()).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources drawn to their target weights; a document stands as often as it is drawn."""
    return mixing.shuffled(mixing.mix(docs)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every drawn document, with digests of the ids and of the text they decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    return bpe.digests(bpe.round_trip(docs, ranks))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dup", near_duplicates), ("mixing", mix), ("bpe", tokens)]

#: SQL expresses neither the classifier nor the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
