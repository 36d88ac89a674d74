"""Lists that keep their order in storage.

A list is written in ranges of its order, one file after another, and a manifest holds
how many rows each file has. So a row's position is the sum of the files before it and
its place in its own file, and neither reading in order nor reading a page needs a sort.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.sources.versions import Versions

#: A frame read in order has one scan per file; longer lists are read by pages or with positions.
MOST_FILES = 1000


def write_ordered(df: DataFrame, root: str, name: str, order: Sequence[str | Column]) -> int:
    """Write a list in its order and return its rows. Rows that tie stand in any order, the same one ever after."""
    versions = Versions(df.sparkSession, root)
    path = versions.new_folder(name)
    df.orderBy(*order).write.parquet(path)
    counted = df.sparkSession.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).count()
    # one row per file; a file's number is that of its range
    files = sorted(counted.collect(), key=lambda r: int(re.match(r"part-(\d+)", r["f"])[1]))
    entry = {"path": path, "schema": df.schema.json(), "files": [[r["f"], r["count"]] for r in files]}
    versions.commit(lambda version: version | {"lists": version.get("lists", {}) | {name: entry}})
    return sum(n for _, n in entry["files"])


class OrderedList:
    """A written list as of the newest commit."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        found = Versions(spark, root).current().get("lists", {})
        if name not in found:
            raise KeyError(f"no list {name!r} under {root}; there are {sorted(found)}")
        self.spark = spark
        self.path = found[name]["path"]
        self.schema = T.StructType.fromJson(json.loads(found[name]["schema"]))
        self.files: list[tuple[str, int, int]] = []
        begin = 0
        for file, rows in found[name]["files"]:
            self.files.append((file, begin, begin + rows))
            begin += rows
        self.rows = begin

    def _file(self, file: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{file}")

    def _stacked(self, files: Sequence[tuple[str, int, int]], position: str | None = None, bounds: tuple[int, int] | None = None) -> DataFrame:
        if len(files) > MOST_FILES:
            raise ValueError(f"{len(files)} files are too many for one plan; read pages, or positions")
        parts = []
        for file, begin, end in files:
            at = F.col("_metadata.row_index") + begin
            part = self._file(file)
            if bounds and (begin < bounds[0] or end > bounds[1]):
                part = part.filter((at >= bounds[0]) & (at < bounds[1]))
            parts.append(part.select(*([at.alias(position)] if position else []), *[F.col(f"`{c}`") for c in self.schema.names]))
        shape = T.StructType(([T.StructField(position, T.LongType())] if position else []) + self.schema.fields)
        return reduce(DataFrame.union, parts) if parts else self.spark.createDataFrame([], shape)

    def read(self) -> DataFrame:
        """All rows in their order: what is collected, shown or written next keeps it."""
        return self._stacked(self.files)

    def page(self, start: int, stop: int, position: str = "position") -> DataFrame:
        """The rows from ``start`` up to, not including, ``stop``, in order; only their files are opened."""
        return self._stacked([f for f in self.files if start < stop and f[1] < stop and f[2] > start], position, (start, stop))

    def with_positions(self, position: str = "position") -> DataFrame:
        """All rows with their positions, for lists of any number of files; the rows themselves are in no order."""
        begins = self.spark.createDataFrame([(f, b) for f, b, _ in self.files], "_file string, _begin bigint")
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        rows = rows.select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_at"))
        # one row per file
        met = rows.join(F.broadcast(begins), F.col("_name") == F.col("_file"))
        return met.select((F.col("_begin") + F.col("_at")).alias(position), *[F.col(f"`{c}`") for c in self.schema.names])
