"""Folders for tables that a job or query writes on the way."""

from __future__ import annotations

import atexit
import contextlib
import functools
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it; where it names none, one in the warehouse, which is shared too."""
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    return named.rstrip("/") if named else _own_folder(spark)


@functools.cache
def _own_folder(spark: SparkSession) -> str:
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/waybill-work"
    folder = Folder(spark, root)
    name = uuid.uuid4().hex
    atexit.register(_quietly, folder.remove, name)
    return folder.path(name)


def _quietly(remove, name: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        remove(name)


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/waybill-{purpose}-{uuid.uuid4().hex}"


def as_table(df: DataFrame, path: str) -> DataFrame:
    """Writes a DataFrame and reads it back: later steps start from files, whatever happens to executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unescape_path(name: str) -> str:
    """A partition value from the name of its folder, where special characters are %XX."""
    return unquote(name, errors="surrogateescape")


class Folder:
    """Existence, removal and small text files below one root, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self._jvm = spark, spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _on(self, path: str):
        handle = self._jvm.org.apache.hadoop.fs.Path(path)
        return handle.getFileSystem(self._conf), handle

    def system(self) -> str:
        """The file system that the root is on."""
        return self._on(self.root)[0].getUri().toString()

    def exists(self, *parts: str) -> bool:
        fs, handle = self._on(self.path(*parts))
        return fs.exists(handle)

    def complete(self, *parts: str) -> bool:
        """Whether a Spark write into this folder has finished."""
        return self.exists(*parts, "_SUCCESS")

    def remove(self, *parts: str) -> None:
        fs, handle = self._on(self.path(*parts))
        fs.delete(handle, True)

    def move(self, parts: tuple[str, ...], destination: str) -> None:
        """Moves a folder to another place of the same file system, in place of what is there."""
        fs, source = self._on(self.path(*parts))
        _, handle = self._on(destination)
        fs.mkdirs(handle.getParent())
        fs.delete(handle, True)
        if not fs.rename(source, handle):
            raise OSError(f"{self.path(*parts)} could not be moved to {destination}")

    def names(self, *parts: str) -> list[str]:
        fs, handle = self._on(self.path(*parts))
        return sorted(s.getPath().getName() for s in fs.listStatus(handle)) if fs.exists(handle) else []

    def read_text(self, *parts: str) -> str | None:
        fs, handle = self._on(self.path(*parts))
        if not fs.exists(handle):
            return None
        stream = fs.open(handle)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def concat(self, parts: list[tuple[str, ...]], destination: str) -> None:
        """Writes files of this folder, one after the other, into one file."""
        fs, handle = self._on(destination)
        out = fs.create(handle, True)
        try:
            for part in parts:
                source, place = self._on(self.path(*part))
                stream = source.open(place)
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
                finally:
                    stream.close()
        finally:
            out.close()

    def write_text(self, text: str, *parts: str) -> None:
        fs, handle = self._on(self.path(*parts))
        stream = fs.create(handle, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
