"""Whole versions of a warehouse: loaded aside, then switched to at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_folder


class Versions:
    """Version folders under ``root`` and a pointer to the one that counts.

    A load writes into the folder ``new`` returns. ``switch`` then replaces the
    pointer by one rename, so a reader sees all tables of the old version or all of
    the new one, and a load that breaks leaves the old one in place.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def new(self) -> str:
        return f"{self.root}/version-{uuid.uuid4().hex[:12]}"

    def switch(self, folder: str) -> None:
        """Let readers see the version in ``folder``; it must be one of ``root``'s own."""
        if not folder.startswith(f"{self.root}/version-"):
            raise ValueError(f"not a version of {self.root}: {folder}")
        aside = self._hadoop.Path(f"{self.root}/pointer-{uuid.uuid4().hex[:12]}")
        context = self._hadoop.FileContext.getFileContext(aside.toUri(), self._conf())
        stream = aside.getFileSystem(self._conf()).create(aside, True)
        stream.write(folder.rsplit("/", 1)[1].encode())
        stream.close()
        how = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(aside, self._hadoop.Path(f"{self.root}/CURRENT"), how)

    def current(self) -> str | None:
        """The folder readers see; None before the first switch."""
        pointer = self._hadoop.Path(f"{self.root}/CURRENT")
        files = pointer.getFileSystem(self._conf())
        if not files.exists(pointer):
            return None
        stream = files.open(pointer)
        try:
            return f"{self.root}/{bytes(stream.readAllBytes()).decode()}"
        finally:
            stream.close()

    def read(self, layer: str, table: str) -> DataFrame:
        folder = self.current()
        if folder is None:
            raise ValueError(f"no version of {self.root} has been switched to")
        return self.spark.read.parquet(f"{folder}/{layer}/{table}")

    def clear(self) -> None:
        """Delete all versions but the current one, broken loads included."""
        kept = self.current()
        path = self._hadoop.Path(f"{self.root}/version-*")
        for found in path.getFileSystem(self._conf()).globStatus(path) or []:
            name = found.getPath().getName()
            if kept is None or not kept.endswith(f"/{name}"):
                delete_folder(self.spark, f"{self.root}/{name}")

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()
