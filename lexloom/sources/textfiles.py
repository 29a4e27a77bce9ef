"""Text files of any length: read in splits, written in order.

``read_pieces`` reads a file in as many tasks as it has splits; a piece ends at a separator (a line end, or an empty line
between paragraphs). Pieces are ordered by (file, split, piece). ``write_text_file`` sorts by ranges, writes a part a
range and joins the parts' bytes, so neither a task nor the driver holds more than a range or a buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.sources.storage import Storage, plain_metadata_name

LINE = "\n"
PARAGRAPH = "\n\n"


def read_pieces(spark: SparkSession, path: str | list[str], separator: str = LINE) -> DataFrame:
    """(file, split, piece, text): ``piece`` grows within a split; bytes that are no UTF-8 are left as they are."""
    pieces = spark.read.option("lineSep", separator).text(path)
    return pieces.select(plain_metadata_name(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("piece"), F.col("value").alias("text"))


def with_offsets(pieces: DataFrame, separator: str = LINE) -> DataFrame:
    """Pieces with ``start``, the byte of their file at which they begin.

    Sizes are added up within each split, and splits, of which a file has few, within each file.
    """
    size = F.octet_length("text") + len(separator.encode())
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    within = pieces.withColumn("within", F.coalesce(F.sum(size).over(before("file", "split", "piece")), F.lit(0)))
    splits = pieces.groupBy("file", "split").agg(F.sum(size).alias("size"))
    bases = splits.select("file", "split", F.coalesce(F.sum("size").over(before("file", "split")), F.lit(0)).alias("base"))
    return within.join(bases, ["file", "split"]).select("file", "split", "piece", (F.col("base") + F.col("within")).alias("start"), "text")


def check_utf8(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces of files that are UTF-8 throughout, and (file, error) of the others."""
    wrong = pieces.groupBy("file").agg(F.count_if(~F.is_valid_utf8("text")).alias("n")).where("n > 0")
    failed = wrong.select("file", F.concat(F.lit("TextCleaningError: no UTF-8 text in "), F.col("n").cast("string"), F.lit(" pieces")).alias("error"))
    return pieces.join(wrong.select("file"), "file", "left_anti"), failed


def write_text_file(texts: DataFrame, path: str, order: list[str | Column], text_col: str = "text", separator: str = LINE) -> None:
    """The texts in order, each with a separator behind it, as one file. ``texts`` is read twice, so it should be a table."""
    spark = texts.sparkSession
    storage, parts = Storage(spark), f"{path}.parts"
    keys = [o if isinstance(o, Column) else F.col(o) for o in order]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.where(F.col(text_col).isNotNull()).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    ordered.select(F.col(text_col).alias("value")).write.mode("overwrite").option("lineSep", separator).text(parts)
    names = [n for n in storage.names(parts) if n.startswith("part-")]
    storage.join([f"{parts}/{n}" for n in sorted(names, key=lambda n: int(n.split("-")[1]))], path)
    storage.delete(parts)
