"""The pipeline over arriving files: exactly once through the checkpoint, inputs archived by the source.

Word lists and dictionaries are read anew for every batch, so a list that is added between two batches counts from the next one on. What a
batch writes is a folder of its own, which a batch that is run again after a failure overwrites.

``read_text_stream`` with ``first_arrivals`` drops files whose contents came before: the digests of contents are the state,
kept for ``KEEP_DIGESTS`` after a file arrives. The clock is the time of the batch, so no file is ever late, however old it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexloom.config import DEFAULT, Config
from lexloom.operators.dictionary import read_dictionaries
from lexloom.plans.pipeline import COUNTERS, clean, clean_counted, observed, word_lists
from lexloom.sources.storage import plain_name

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
FILES = "path string, modificationTime timestamp, length long, content binary"  # as the source gives them
#: The source skips files that are so much older than its newest one, and remembers the names of younger ones.
MAX_FILE_AGE = "36500d"
KEEP_DIGESTS = "30 days"


def _arriving(spark: SparkSession, archive: str | None, files_a_batch: int):
    reader = spark.readStream.option("maxFilesPerTrigger", files_a_batch).option("maxFileAge", MAX_FILE_AGE)
    return reader.option("cleanSource", "archive").option("sourceArchiveDir", archive) if archive else reader


def read_stream(spark: SparkSession, folder: str, schema: T.StructType = DOCUMENTS, archive: str | None = None, files_a_batch: int = 1000) -> DataFrame:
    """Parquet files as they arrive; with ``archive`` the source moves what it has finished."""
    return _arriving(spark, archive, files_a_batch).schema(schema).parquet(folder)


def read_text_stream(spark: SparkSession, folder: str, pattern: str = "*.txt", archive: str | None = None, files_a_batch: int = 1000) -> DataFrame:
    """(file, text, digest, error, arrived): whole text files as they arrive; one that is no UTF-8 has an error and no text."""
    found = _arriving(spark, archive, files_a_batch).format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).load(folder)
    content = F.col("content").cast("string")
    valid = F.is_valid_utf8(content)
    return found.select(
        plain_name(F.col("path")).alias("file"),
        F.when(valid, content).alias("text"),
        F.sha2("content", 256).alias("digest"),
        F.when(~valid, F.lit("TextCleaningError: no UTF-8 text")).alias("error"),
        F.current_timestamp().alias("arrived"),
    )


def first_arrivals(stream: DataFrame, keep: str = KEEP_DIGESTS) -> DataFrame:
    """Rows whose digest did not come before, as far as digests are kept."""
    return stream.withWatermark("arrived", keep).dropDuplicatesWithinWatermark(["digest"])


def clean_stream(docs: DataFrame, output: str, checkpoint: str, config: Config = DEFAULT, manifest: str | None = None) -> StreamingQuery:
    """Clean whatever is there and stop (``availableNow``); with ``manifest`` a row of counts is added per batch.

    Without a manifest, word lists and dictionaries the cleaned rows go to a plain file sink.
    """
    if manifest is None and config.dictionary_folder is None and word_lists(docs.sparkSession, config) is None:
        return clean(docs, config).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(output)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        cleaned, seen = observed(clean_counted(batch, word_lists(spark, config), config, dictionary=read_dictionaries(spark, config)))
        cleaned.write.mode("overwrite").parquet(f"{output}/batch={number}")
        if manifest is not None:
            stored = spark.read.parquet(f"{output}/batch={number}")
            counts = stored.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n_chars"))
            removed = F.create_map(*(x for name in COUNTERS for x in (F.lit(name), F.lit(seen.get[name]).cast("long"))))
            counts.select(F.lit(number).cast("long").alias("batch"), F.current_timestamp().alias("ts"), "n_rows", "n_chars", removed.alias("counts")).write.mode("overwrite").parquet(f"{manifest}/batch={number}")

    return docs.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
