"""Numbered commits by put-if-absent.

A commit is one small JSON file ``<root>/<name>/<number>.json`` that is created
only if no file of that name exists, so of two writers that reach for a number
one gets it and the other sees so and takes the next.  The file is the version
row; readers list the folder as a table.

The check-and-create is the file system's own ``create`` without overwrite,
atomic on HDFS, on local disks and on object stores with conditional writes.
A writer that dies between creating and filling leaves an empty file: the number
is spent and the table skips it.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CommitLog:
    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _file(self, path: str):
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf), p

    def put_if_absent(self, name: str, number: int, row: dict) -> bool:
        """Create commit ``number`` of ``name``; False if it exists."""
        fs, path = self._file(f"{self.root}/{name}/{number:010d}.json")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if fs.exists(path):
                return False
            raise e
        out.write(bytearray((json.dumps(row) + "\n").encode("utf-8")))
        out.close()
        return True

    def numbers(self, name: str) -> list[int]:
        """Numbers taken so far: the names in one folder, one entry a commit."""
        fs, path = self._file(f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        found = (s.getPath().getName() for s in fs.listStatus(path))
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith("."))

    def append(self, name: str, row) -> int:
        """Commit ``row(number)`` under the next free number and return it."""
        number = max(self.numbers(name), default=0) + 1
        while not self.put_if_absent(name, number, row(number)):
            number += 1
        return number

    def table(self) -> DataFrame:
        """All commits as rows."""
        try:
            rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").json(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)  # no commit yet
        first = self.schema.fieldNames()[0]
        return rows.where(F.col(first).isNotNull())
