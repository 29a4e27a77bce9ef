"""Schemas of many Parquet files without a job for each: tasks read the footers.

A task opens a file by Arrow's own file systems and reads its footer alone. What tasks cannot reach that way (a store that only
Hadoop knows) the driver reads through Hadoop, several files at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import SparkSession

from lexloom.errors import ValidationError
from lexloom.session import ship

FILES_A_TASK = 200
AT_ONCE = 16  # footers that the driver reads at a time
FOUND = "file string, kind string, error string, reached boolean"


def _said(error: Exception) -> str:
    return f"{type(error).__name__}: {(str(error).splitlines() or [''])[0]}"


def _opened(file: str):
    """A readable file, or None if Arrow cannot get at it here."""
    from pyarrow import fs

    try:
        system, name = (fs.LocalFileSystem(), file) if file.startswith("/") else fs.FileSystem.from_uri(file)
        return system.open_input_file(name)
    except (OSError, pa.ArrowException):
        return None


def _in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for file in batch.column(0).to_pylist():
            kind = error = None
            opened = _opened(file)
            if opened is not None:
                with opened:
                    try:
                        if opened.size() == 0:
                            raise ValidationError("the file is empty")
                        kind = pq.read_schema(opened).remove_metadata().to_string(truncate_metadata=False)
                    except Exception as failed:  # a bad file must not end the run; it is told in the manifest
                        error = _said(failed)
            rows.append((file, kind, error, opened is not None))
        kinds = [pa.string(), pa.string(), pa.string(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["file", "kind", "error", "reached"])


def _through_hadoop(spark: SparkSession, files: list[str]) -> list[tuple[str | None, str | None]]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def one(file: str) -> tuple[str | None, str | None]:
        try:
            source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
            try:
                return reader.getFileMetaData().getSchema().toString(), None
            finally:
                reader.close()
        except Exception as failed:  # as in tasks
            return None, _said(getattr(failed, "java_exception", None) and Exception(failed.java_exception.toString()) or failed)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(one, files))


def file_kinds(spark: SparkSession, files: list[str]) -> list[tuple[str, str | None, str | None]]:
    """(file, kind, error) of every file, by name; files of one kind have one schema.

    The driver has these names, as Spark's reader of the files needs them there.
    """
    listed = ship(spark).createDataFrame([(f,) for f in files], "file string")
    found = listed.repartition(max(1, -(-len(files) // FILES_A_TASK))).mapInArrow(_in_task, FOUND).collect()
    left = [r.file for r in found if not r.reached]
    later = dict(zip(left, _through_hadoop(spark, left), strict=True))
    return sorted((r.file, *later.get(r.file, (r.kind, r.error))) for r in found)
