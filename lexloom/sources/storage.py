"""Files and folders through Hadoop's file systems, so that a workspace may lie in any store that Spark reads.

Names are as users write them: nothing is percent-encoded, and local ones have no scheme.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lexloom.errors import MissingFileError, ValidationError

#: As it is written by ``Path.toString``, of which a local file's has one slash.
_LOCAL = "^file:/+"


def plain_name(path: Column) -> Column:
    """A path column of Spark's file sources that hold names as they are (``binaryFile``)."""
    return F.regexp_replace(path, _LOCAL, "/")


def plain_metadata_name(path: Column) -> Column:
    """``_metadata.file_path``, which is percent-encoded. A plus sign is no blank in a path."""
    return plain_name(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def literal(path: str) -> str:
    """A path that Spark's readers take as it is, whatever characters are in it."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


class StoredFile(NamedTuple):
    file: str
    length: int
    modified: int  # milliseconds


class Storage:
    """What a run does to files and folders on the driver."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self, name: str):
        return self._path(name).getFileSystem(self._conf)

    def full_name(self, name: str) -> str:
        """The absolute name of a path, without a scheme where it is local."""
        return re.sub(_LOCAL, "/", self._fs(name).makeQualified(self._path(name)).toString())

    def exists(self, name: str) -> bool:
        return self._fs(name).exists(self._path(name))

    def same(self, name: str, length: int, modified: int) -> bool:
        """Whether the file is there and is the one that was so long and changed then (in milliseconds)."""
        if not self.exists(name):
            return False
        status = self._fs(name).getFileStatus(self._path(name))
        return (status.getLen(), status.getModificationTime()) == (length, modified)

    def check_folder(self, name: str) -> str:
        if not self.exists(name):
            raise MissingFileError(f"{name} does not exist")
        if not self._fs(name).getFileStatus(self._path(name)).isDirectory():
            raise ValidationError(f"{name} is no folder")
        return name

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs(folder).listStatus(self._path(folder))) if self.exists(folder) else []

    def files(self, folder: str, suffix: str) -> list[StoredFile]:
        """A folder's files by name, not those of folders below, nor hidden ones; empty ones too, which Spark's readers skip."""
        found = []
        for status in self._fs(folder).listStatus(self._path(folder)):
            name = status.getPath().getName()
            if name.endswith(suffix) and name[0] not in "._" and status.isFile():
                found.append(StoredFile(re.sub(_LOCAL, "/", status.getPath().toString()), status.getLen(), status.getModificationTime()))
        return sorted(found)

    def make_folder(self, name: str) -> None:
        self._fs(name).mkdirs(self._path(name))

    def delete(self, name: str) -> None:
        self._fs(name).delete(self._path(name), True)

    def rename(self, source: str, target: str) -> None:
        """Atomic within a file system; it fails if the target exists."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs(source).getUri(), self._conf)
        context.rename(self._path(source), self._path(target), self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def move(self, source: str, target: str) -> None:
        """As ``rename``, or a copy that appears whole under its name where the target lies in another file system."""
        a, b = self._fs(source), self._fs(target)
        if a.getUri().toString() == b.getUri().toString():
            self.rename(source, target)
            return
        aside = f"{target}.moving"
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(a, self._path(source), b, self._path(aside), False, True, self._conf)
        self.rename(aside, target)
        self.delete(source)

    def write(self, name: str, text: str) -> None:
        """A small file that appears whole or not at all."""
        aside = f"{name}.writing"
        stream = self._fs(name).create(self._path(aside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.rename(aside, name)

    def read(self, name: str) -> str:
        stream = self._fs(name).open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def join(self, parts: list[str], target: str) -> None:
        """One file of the parts' bytes, in order and through a buffer of fixed size; the parts go."""
        fs = self._fs(target)
        out = fs.create(self._path(target), True)
        try:
            for part in parts:
                stream = fs.open(self._path(part))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 4 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()
        for part in parts:
            self.delete(part)
