"""Files and folders of a table on any file system Spark can reach."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        return self._files(self._path(path)).exists(self._path(path))

    def _folders(self, path: str) -> list[str]:
        """Names of the partition folders."""
        found = self._files(self._path(path)).listStatus(self._path(path))
        return sorted(f.getPath().getName() for f in found if f.isDirectory())

    def _store(self, path: str, content: dict) -> None:
        out = self._files(self._path(path)).create(self._path(path), True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()

    def _load(self, path: str) -> dict:
        source = self._files(self._path(path)).open(self._path(path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def _drop(self, path: str) -> None:
        target = self._path(path)
        self._files(target).delete(target, True)
