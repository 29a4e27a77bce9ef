"""Sharding by size-tiered compaction, with versioned manifests that are committed atomically.

``append`` writes arrivals as small immutable shards. ``compact`` merges runs of similarly sized shards (one tier holds
sizes within a factor of ``FAN``) straight into files of about the target size: a merge reads and writes each row once and
shuffles nothing, and takes at most ``RUN`` shards at a time. Every change is a new manifest. A manifest names shard lists,
which are small Parquet tables of files, rows and bytes, so an append adds one list and rewrites none, and tiers are counted
by a query. A list whose shards are all there names their folder, which is read as a whole; only of lists that lost shards
to a merge are file names looked at. The manifest is written aside and renamed to its number, which fails if another writer was faster, so readers
see a whole version or the one before. Shards and lists are never changed; ``expire`` deletes what no kept manifest names.

Schemas may grow: a version's schema has every column that any arrival had, and rows of arrivals without it read as null there.
An arrival whose column has another type, or a name that differs in case alone, raises ``SchemaConflict`` before anything is
written.

Cases: rows are stored as they are, with all their columns, nulls, empty and long texts, repeated rows and ids; no rows
make a version without shards, which reads as an empty table of the stored schema; a shard larger than the target is left
alone; a failed write leaves files that no manifest names; a commit that lost the race raises ``CommitConflict`` and can be
repeated.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.sources.scratch import scratch_path

TARGET_BYTES = 64 << 20
SHARD_ROWS = 2_000  # rows of an arriving shard
RUN = 10_000  # shards that one merge reads
LIST = "file string, rows long, bytes long"
FAN = 4  # sizes of one tier differ by this factor at most; so many shards of a tier are merged


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


class SchemaConflict(ValueError):
    """An arrival's column has another type than the stored one."""


def widened(stored: T.StructType, arriving: T.StructType) -> T.StructType:
    """The stored schema with the arriving one's new columns; all columns may be null."""
    known = {f.name.lower(): f for f in stored.fields}
    out = list(stored.fields)
    for field in arriving.fields:
        own = known.get(field.name.lower())
        if own is None:
            out.append(field)
            known[field.name.lower()] = field
        elif own.name != field.name or _nullable(own.dataType) != _nullable(field.dataType):
            raise SchemaConflict(f"{field.name} {field.dataType.simpleString()} arrives, but {own.name} {own.dataType.simpleString()} is stored")
    return _nullable(T.StructType(out))


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere and without metadata."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


class ShardStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list[tuple[str, int]]:
        path = self._path(f"{self.root}/{folder}")
        return [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    # manifests

    def versions(self) -> list[int]:
        return sorted(int(name[1:-5]) for name, _ in self._names("manifests") if name.startswith("v") and name.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """{"version", "schema", "lists"}; version 0 is empty. A list is {"name", "folder"}; no folder: only some of its shards."""
        known = self.versions()
        version = (known[-1] if known else 0) if version is None else version
        if version == 0:
            return {"version": 0, "schema": None, "lists": []}
        stream = self._fs.open(self._path(f"{self.root}/manifests/v{version:08d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def shards(self, version: int | None = None) -> DataFrame:
        """(file, rows, bytes) of a version's shards."""
        return self._listed(self.manifest(version)["lists"])

    def _listed(self, lists: list[dict]) -> DataFrame:
        if not lists:
            return self.spark.createDataFrame([], LIST)
        return self.spark.read.schema(LIST).parquet(*(f"{self.root}/{x['name']}" for x in lists))

    def _list(self, shards: DataFrame, folder: str | None) -> dict:
        name = f"lists/{uuid.uuid4().hex}"
        shards.select(F.col("file").cast("string").alias("file"), F.col("rows").cast("long").alias("rows"), F.col("bytes").cast("long").alias("bytes")).write.parquet(f"{self.root}/{name}")
        return {"name": name, "folder": folder}

    def _commit(self, base: dict, schema: str, lists: list[dict]) -> int:
        version = base["version"] + 1
        aside = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps({"version": version, "schema": schema, "lists": lists}).encode()))
        finally:
            stream.close()
        gateway = self.spark.sparkContext._gateway
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        target = self._path(f"{self.root}/manifests/v{version:08d}.json")
        try:
            context.rename(aside, target, gateway.new_array(rename, 0))
        except Exception as error:
            self._fs.delete(aside, False)
            if self._fs.exists(target):
                raise CommitConflict(f"version {version} exists") from error
            raise
        return version

    # shards

    def _write(self, df: DataFrame, rows: int | None) -> dict:
        """The list of the shards that were written."""
        folder = f"data/{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd")
        (writer.option("maxRecordsPerFile", rows) if rows else writer).parquet(f"{self.root}/{folder}")
        made = self.spark.read.parquet(f"{self.root}/{folder}").select(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("bytes"))
        return self._list(made.groupBy("name", "bytes").agg(F.count("*").alias("rows")).select(F.concat(F.lit(f"{folder}/"), "name").alias("file"), "rows", "bytes"), folder)

    def append(self, df: DataFrame, shard_rows: int = SHARD_ROWS) -> int:
        """Add rows as small shards; returns the new version."""
        base = self.manifest()
        schema = widened(T.StructType.fromJson(json.loads(base["schema"])) if base["schema"] else T.StructType(), df.schema)
        return self._commit(base, schema.json(), [*base["lists"], self._write(df, shard_rows)])

    def _merge(self, tier: DataFrame, count: int, total: int, target_bytes: int, schema: str) -> list[dict]:
        """Lists of the shards that a tier's shards were merged into, in runs of at most about RUN."""
        runs = -(-count // RUN)
        lists = []
        for run in range(runs):
            files = [r.file for r in tier.where(F.pmod(F.xxhash64("file"), F.lit(runs)) == run).select("file").orderBy("file").collect()]
            into = min(max(1, round(total / runs / target_bytes)), max(1, len(files) // 2))
            if files:
                lists.append(self._write(self._read([f"{self.root}/{f}" for f in files], schema).coalesce(into), None))
        return lists

    def _tiered(self, lists: list[dict], target_bytes: int) -> DataFrame:
        """Shards with the power of FAN of their sizes, or -1 for those that are large enough."""
        tier = F.when(F.col("bytes") < target_bytes, F.floor(F.log(F.greatest("bytes", F.lit(1))) / F.log(F.lit(float(FAN))))).otherwise(-1)
        return self._listed(lists).withColumn("tier", tier)

    def compact(self, target_bytes: int = TARGET_BYTES) -> int:
        """Merge every tier with at least FAN shards; the version, which is new if anything was merged."""
        base = self.manifest()
        lists = base["lists"]
        while True:
            tiered = self._tiered(lists, target_bytes)
            full = tiered.where("tier >= 0").groupBy("tier").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).where(F.col("n") >= FAN).collect()  # some twenty tiers at most
            if not full:
                break
            goes = F.col("tier").isin([r.tier for r in full])
            named = tiered.withColumn("list", F.regexp_extract("_metadata.file_path", "(lists/[0-9a-f]+)/[^/]*$", 1))
            touched = {r["list"] for r in named.where(goes).select("list").distinct().collect()}  # of the lists, as many as writes since they were merged
            made = [x for x in lists if x["name"] not in touched]
            left = self._tiered([x for x in lists if x["name"] in touched], target_bytes).where(~goes)
            if left.head(1):
                made.append(self._list(left, None))
            for run in full:
                merged = self._merge(tiered.where(F.col("tier") == run.tier), run.n, run.bytes, target_bytes, base["schema"])
                if self._listed(merged).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] != run.rows:
                    raise RuntimeError("a merge changed the number of rows")
                made += merged
            lists = made
        return self._commit(base, base["schema"], lists) if lists is not base["lists"] else base["version"]

    def _read(self, paths: list[str], schema: str | None) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema)) if schema else T.StructType()
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def read(self, version: int | None = None) -> DataFrame:
        """A version's rows."""
        found = self.manifest(version)
        paths = [f"{self.root}/{x['folder']}" for x in found["lists"] if x["folder"]]
        for part in found["lists"]:
            if not part["folder"]:
                paths += [f"{self.root}/{r.file}" for r in self._listed([part]).select("file").collect()]
        return self._read(paths, found["schema"])

    def expire(self, keep: int = 1) -> int:
        """Forget all but the last ``keep`` versions and delete shards that none of those names; how many went."""
        known = self.versions()
        old, kept = ({x["name"] for v in part for x in self.manifest(v)["lists"]} for part in (known[:-keep], known[-keep:]))
        names = lambda found: self._listed([{"name": n} for n in sorted(found)]).select("file")
        gone, went = names(old).distinct().join(names(kept), "file", "left_anti"), 0
        for row in gone.toLocalIterator():  # a partition's names at a time
            self._fs.delete(self._path(f"{self.root}/{row.file}"), False)
            went += 1
        for v in known[:-keep]:
            self._fs.delete(self._path(f"{self.root}/manifests/v{v:08d}.json"), False)
        for name in old - kept:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
        return went


ARRIVALS = 7  # of about one size, so that one of the two tiers they may lie in has at least FAN


def op2_sharding(spark, sf_dir) -> DataFrame:
    """The whole table in several arrivals of small shards, compacted: per row its digest and the file that holds it."""
    from lexloom.llm.common import table

    store = ShardStore(spark, scratch_path(spark, "shards"))
    docs = table(spark, sf_dir, "documents")
    for n in range(ARRIVALS):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)) == n))
    store.compact()
    shard = F.regexp_extract("_metadata.file_path", "data/([^/]+/[^/]+)$", 1)
    return store.read().select("doc_id", shard.alias("shard"), F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("text_sha256"), F.length("text").cast("long").alias("stored_chars"))
