"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from lexloom.errors import ConfigurationError

_LOCAL: dict[str, str] = {}
_TABLES: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, or what ``setCheckpointDir`` named.

    A local session (tests) may do without; a cluster may not, since its machines do not see each other's folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ConfigurationError("spark.checkpoint.dir has to name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="lexloom-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/lexloom/{tag}-{uuid.uuid4().hex}"


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Have a scratch folder that exists removed when the application ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def materialize(df: DataFrame, tag: str, compression: str = "zstd", rows_a_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage as ``checkpoint()`` does, but the copy is columnar and compressed, later reads
    are pruned to the columns they need, and a lost executor costs no recomputation. It lasts as long as the application.
    Rows of many megabytes need ``rows_a_file``: Parquet's writer looks at its size every 100 rows only, and its reader takes a
    file's rows in batches of thousands, so that both would hold all of a task's rows. 0 sets no limit.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", compression).option("maxRecordsPerFile", rows_a_file).parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _drop_tables() -> None:
    """Forget the names of bucketed tables; their files go with the application's scratch folders."""
    for spark, name in _TABLES:
        if spark.sparkContext._jsc is None:
            continue
        try:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # the session may have ended before; then only a lasting catalog still has the name
            continue


def materialize_bucketed(df: DataFrame, key: str, tag: str, compression: str = "zstd") -> DataFrame:
    """As ``materialize``, in as many buckets of ``key`` as there are shuffle partitions.

    A later join or cogroup by that key reads the table where it lies instead of shuffling it. The session's catalog
    knows the table by a name of its own.
    """
    spark = df.sparkSession
    name = f"{tag}_{uuid.uuid4().hex}"
    path = scratch_path(spark, tag)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("compression", compression).option("path", path).saveAsTable(name)
    discard_at_exit(spark, path)
    _TABLES.append((spark, name))
    return spark.table(name)
