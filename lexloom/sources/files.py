"""Folder scans, path checks, and the sinks of a run."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.config import DEFAULT, Config
from lexloom.errors import MissingFileError, ParquetProcessingError, ValidationError
from lexloom.operators.flatten import row_text
from lexloom.session import ship
from lexloom.sources.footers import file_kinds
from lexloom.sources.pdf import pdf_pages
from lexloom.sources.storage import Storage, literal, plain_metadata_name, plain_name

MANIFEST = "processor string, file string, ts timestamp, n_chars long, n_bytes long, n_units int, error string, counts map<string,bigint>"
ROWS = "file string, pos long, text string, error string"
DEFAULT_LEVEL = 1
#: Takes a file's bytes, the tolerance levels to try as (level, x tolerance, y tolerance), and whether to keep the layout;
#: yields (page number, level, text) for every page and attempt.
PdfExtractor = Callable[[bytes, list[tuple[int, float, float]], bool], list[tuple[int, int, str]]]


def tolerance_levels(config: Config = DEFAULT) -> list[tuple[int, float, float]]:
    """Tight, configured and loose tolerances, or the configured ones alone where extraction does not adapt."""
    levels = [(0, 1, 1), (DEFAULT_LEVEL, config.pdf_x_tolerance, config.pdf_y_tolerance), (2, 5, 5)]
    return levels if config.pdf_adaptive_tolerance else [levels[DEFAULT_LEVEL]]


def check_path(path: str) -> str:
    if not os.path.exists(path):
        raise MissingFileError(f"{path} does not exist")
    return path


def check_folder(path: str) -> str:
    if not os.path.isdir(check_path(path)):
        raise ValidationError(f"{path} is no folder")
    return path


def check_file(path: str, suffix: str | None = None) -> str:
    if not os.path.isfile(check_path(path)):
        raise ValidationError(f"{path} is no file")
    if suffix and not path.lower().endswith(suffix):
        raise ValidationError(f"{path} is no {suffix} file")
    if os.path.getsize(path) == 0:
        raise ValidationError(f"{path} is empty")
    return path


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): whole files. Bytes that are no UTF-8 are an error, as nothing should be replaced unseen."""
    raw = spark.read.format("binaryFile").load(path)
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return raw.select(F.col("path").alias("file"), F.when(valid, F.col("content").cast("string")).otherwise(F.raise_error(F.concat(F.lit("no UTF-8 text: "), F.col("path")))).alias("text"))


def read_parquet_rows(spark: SparkSession, paths: list[str], parity: bool = False) -> DataFrame:
    """(file, pos, text, error): a row for every row of the files; ``text`` is null for rows and files that hold none.

    Every file is read by its own schema, which tasks read from the footers: files of one schema are read together, and only
    their text columns. A file that is no readable Parquet is one row with its error; one without rows, or without text columns,
    is a row without text. ``pos`` is the row's number in its file.
    """
    storage = Storage(spark)
    kinds = file_kinds(spark, [storage.full_name(p) for p in paths])
    by_kind: dict[str, list[str]] = {}
    for file, kind, _ in kinds:
        if kind is not None:
            by_kind.setdefault(kind, []).append(literal(file))
    out = spark.createDataFrame([(file, None, None, error) for file, _, error in kinds], ROWS)
    for group in by_kind.values():
        table = spark.read.schema(spark.read.parquet(group[0]).schema).parquet(*group)
        named = table.select("*", plain_metadata_name(F.col("_metadata.file_path")).alias("__lexloom_file"), F.col("_metadata.row_index").alias("__lexloom_pos"))
        texts = row_text(named, table.columns, parity, keep=("__lexloom_file", "__lexloom_pos"))
        out = out.unionByName(texts.select(F.col("__lexloom_file").alias("file"), F.col("__lexloom_pos").alias("pos"), "text", F.lit(None).cast("string").alias("error")))
    return out


def read_parquet_texts(spark: SparkSession, folder: str, parity: bool = False) -> DataFrame:
    """(file, text): a row for every row of the folder's ``*.parquet`` files that holds text; unreadable files are left out."""
    found = [f.file for f in Storage(spark).files(Storage(spark).check_folder(folder), ".parquet")]
    if not found:
        raise ParquetProcessingError(f"{folder} holds no Parquet files")
    return read_parquet_rows(spark, found, parity).where("text is not null").select("file", "text")


def extract_pages(content: bytes, levels: list[tuple[int, float, float]], layout: bool = True) -> list[tuple[int, int, str]]:
    """The default extractor: pages of a PDF at every tolerance level, or of a text layer that was exported with form feeds."""
    if b"%PDF-" in content[:1024]:
        return pdf_pages(content, levels, layout)
    return [(n, DEFAULT_LEVEL, page) for n, page in enumerate(content.decode("utf-8").split("\f"), 1)]


def read_pdf_pages(spark: SparkSession, folder: str | list[str], extractor: PdfExtractor = extract_pages, pattern: str = "*.pdf", config: Config = DEFAULT) -> DataFrame:
    """(file, page, level, text, error): every attempt of every page of a folder's files, or of listed ones; a file that fails is one row with its error."""
    ship(spark)
    levels, layout = tolerance_levels(config), config.pdf_layout_mode

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows += [(file, page, level, text, None) for page, level, text in extractor(content, levels, layout)]
                except Exception as error:  # a bad file must not end the run; it is told in the manifest
                    rows.append((file, None, None, None, f"{type(error).__name__}: {error}"))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["file", "page", "level", "text", "error"])

    paths = [literal(f) for f in folder] if isinstance(folder, list) else literal(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths).select(plain_name(F.col("path")), "content")
    return files.mapInArrow(run, "file string, page int, level int, text string, error string")


def manifest(processor: str, units: DataFrame) -> DataFrame:
    """(file, text, error and perhaps warning) with a row per page or row of a file -> a manifest row per file.

    ``counts`` says how many units have each warning; it is null where no unit has one.
    """
    warning = F.col("warning") if "warning" in units.columns else F.lit(None).cast("string")
    by_message = units.groupBy("file", warning.alias("message")).agg(F.sum(F.length("text")).alias("chars"), F.sum(F.octet_length("text")).alias("bytes"), F.count("text").alias("units"), F.count("*").alias("n"), F.max("error").alias("error"))
    told = F.collect_list(F.when(F.col("message").isNotNull(), F.struct("message", "n")))  # few messages a file
    return by_message.groupBy("file").agg(
        F.coalesce(F.sum("chars"), F.lit(0)).cast("long").alias("n_chars"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("n_bytes"),
        F.sum("units").cast("int").alias("n_units"),
        F.max("error").alias("error"),
        F.when(F.size(told) > 0, F.map_from_entries(told)).alias("counts"),
    ).select(F.lit(processor).alias("processor"), "file", F.current_timestamp().alias("ts"), "n_chars", "n_bytes", "n_units", "error", "counts")


def append_texts(texts: DataFrame, path: str) -> None:
    texts.write.mode("append").parquet(path)


def overwrite_texts(texts: DataFrame, path: str) -> None:
    texts.write.mode("overwrite").parquet(path)


def run_folder(results: str, now: datetime | None = None) -> str:
    return os.path.join(results, (now or datetime.now()).strftime("%d-%m-%y-%H-%M-%S"))

