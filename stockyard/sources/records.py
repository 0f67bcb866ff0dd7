"""Small JSON records in a shared folder, each created under its own name or not at all.

A record is written aside and renamed into place without overwriting: a name is given once, whoever asks first, and
a reader sees a whole record or none.  This rests on the file system's rename, which stores made for
Spark's own checkpoints provide.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Records:
    """Records of one schema below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._hadoop = spark._jvm.org.apache.hadoop
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _rename(self, source, target, kind: str) -> bool:
        """Whether the target was free (or may be overwritten)."""
        options = self.spark._sc._gateway.new_array(self._hadoop.fs.Options.Rename, 1)
        options[0] = getattr(self._hadoop.fs.Options.Rename, kind)
        context = self._hadoop.fs.FileContext.getFileContext(source.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(source, target, options)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True

    def _write(self, name: str, records: list[dict], kind: str) -> bool:
        aside = self._at(f"_{name}-{uuid.uuid4().hex[:12]}")
        out = self._fs.create(self._fs.makeQualified(aside), True)
        out.write(bytearray("".join(json.dumps(r) + "\n" for r in records).encode()))
        out.close()
        won = self._rename(self._fs.makeQualified(aside), self._fs.makeQualified(self._at(f"{name}.json")), kind)
        if not won:
            self._fs.delete(aside, False)
        return won

    def create(self, name: str, *records: dict) -> bool:
        """False, and nothing is changed, if the name is taken."""
        return self._write(name, list(records), "NONE")

    def replace(self, name: str, *records: dict) -> None:
        self._write(name, list(records), "OVERWRITE")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(f"{name}.json"), False)

    def names(self) -> list[str]:
        """Names in sorted order."""
        if not self._fs.exists(self._at()):
            return []
        found = (f.getPath().getName() for f in self._fs.listStatus(self._at()))
        return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and n[0] not in "_.")

    def read(self, names: list[str] | None = None) -> DataFrame:
        """All records, or those of some names."""
        names = self.names() if names is None else names
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).json([f"{self.path}/{n}.json" for n in names])
