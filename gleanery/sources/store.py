"""Folders on any file system that Spark opens: small files by the driver, all else by jobs.

``Store`` is a handle to Hadoop's file system for what is small and single: marks, manifests, renames. Tables and checksums are
jobs: Spark's writers commit a table's files together when all its tasks have, so a task that is killed halfway leaves nothing that a reader sees."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def get(self, name: str) -> bytes:
        """A small file's content; FileNotFoundError without it."""
        if not self.exists(name):
            raise FileNotFoundError(f"{self.root}/{name}")
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def put(self, name: str, content: bytes) -> bool:
        """Create a file whole if there is none of that name (True); one of the same content stays (False), another raises FileExistsError.

        Written beside and renamed, so that nobody sees a part of it; Hadoop's rename doesn't replace a file."""
        if self.exists(name):
            if self.get(name) != content:
                raise FileExistsError(f"{self.root}/{name}")
            return False
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self._fs.create(self._at(part), False)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        if not self._fs.rename(self._at(part), self._at(name)):
            self._fs.delete(self._at(part), False)
            return self.put(name, content) if self.exists(name) else _no(f"{self.root}/{name} can't be made")
        return True

    def put_json(self, name: str, value: dict) -> bool:
        return self.put(name, json.dumps(value, sort_keys=True, indent=1).encode())

    def get_json(self, name: str) -> dict:
        return json.loads(self.get(name))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def move_to(self, target: str) -> None:
        """Rename the whole folder; FileExistsError if the target is there."""
        other = Store(self.spark, target)
        if other.exists():
            raise FileExistsError(target)
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._at(""), self._path(target)):
            raise OSError(f"{self.root} can't be moved to {target}")
        self.root = target.rstrip("/")

    def folder(self, name: str) -> Store:
        return Store(self.spark, f"{self.root}/{name}")

    def tables(self) -> list[str]:
        """Names of the folders right below."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at("")) if s.isDirectory())


def _no(why: str) -> bool:
    raise OSError(why)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(name, sha256, bytes) of every file below a folder but those that begin with a dot or an underscore, read where the executors are."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # A path's own scheme and authority may be written otherwise than the root's: names are what follows the root's last folders.
    top = root.rstrip("/").split("://", 1)[-1].partition("/")[2]
    name = F.expr(f"substring(path, instr(path, '/{top}/') + {len(top) + 2})")
    return files.select(name.alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
