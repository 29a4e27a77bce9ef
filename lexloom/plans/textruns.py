"""Cleaning of text files of any length.

A file is read in paragraphs, by as many tasks as it has splits. An empty line is a boundary that healing never crosses, so
paragraphs clean like the whole, but for one case: a run of single letters that goes on over an empty line counts as two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.config import DEFAULT, Config
from lexloom.errors import TextCleaningError
from lexloom.plans import pipeline
from lexloom.sources import textfiles
from lexloom.sources.scratch import materialize
from lexloom.sources.storage import literal


def clean_paragraphs(pieces: DataFrame, config: Config = DEFAULT, detect=None) -> DataFrame:
    """(file, split, piece, text) cleaned, without paragraphs of which nothing is left."""
    return pipeline.clean_rows(pieces, config, detect).where("text <> ''")


def clean_files(spark: SparkSession, paths: list[str], config: Config = DEFAULT, detect=None) -> tuple[DataFrame, DataFrame]:
    """Cleaned paragraphs of all files that are UTF-8 throughout, and (file, error) of the others."""
    pieces = textfiles.read_pieces(spark, [literal(p) for p in paths], textfiles.PARAGRAPH)
    good, failed = textfiles.check_utf8(pieces)
    return clean_paragraphs(good, config, detect), failed


def clean_file(spark: SparkSession, path: str, output: str, config: Config = DEFAULT, detect=None) -> None:
    """One text file cleaned into another: its words with single spaces between them."""
    cleaned, failed = clean_files(spark, [path], config, detect)
    if wrong := failed.first():
        raise TextCleaningError(f"{path}: {wrong.error}")
    textfiles.write_text_file(materialize(cleaned, "cleaned-text"), output, [F.col("split"), F.col("piece")], separator=" ")
