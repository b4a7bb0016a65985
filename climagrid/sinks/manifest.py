"""A folder of numbered versions of a small document, where a version is made by one writer only."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """A Hadoop path and its file system, which every store that Spark can write to has."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Manifest:
    """Versions 1, 2, ... of a JSON object below ``path``; ``empty`` is what version 0 reads as."""

    def __init__(self, spark: SparkSession, path: str, empty: dict):
        self.spark, self.path, self.empty = spark, path.rstrip("/"), empty

    def newest(self) -> tuple[int, dict]:
        """The newest version and its number."""
        folder, files = file_system(self.spark, self.path)
        if not files.exists(folder):
            return 0, self.empty
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not versions:
            return 0, self.empty
        text = self.spark.read.text(self._file(max(versions)), wholetext=True).first()[0]
        return max(versions), json.loads(text)

    def create(self, version: int, content: dict) -> bool:
        """Write a version if it does not exist yet. The file gets its name only when it is complete, and never replaces another."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        part, files = file_system(self.spark, f"{self._file(version)}-{uuid.uuid4().hex}.part")
        stream = files.create(part, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        kind = getattr(hadoop, "Options$Rename")
        keep = self.spark.sparkContext._gateway.new_array(kind, 1)
        keep[0] = kind.NONE
        context = hadoop.FileContext.getFileContext(self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(part, hadoop.Path(self._file(version)), keep)
        except Py4JJavaError as error:
            files.delete(part, False)
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            return False
        return True

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"
