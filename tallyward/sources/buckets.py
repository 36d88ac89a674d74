"""Tables laid out by a key, so that joins and sums by that key shuffle nothing.

A row's bucket follows from its key, and each bucket is one file. Two tables with equally
many buckets of the same key are joined bucket by bucket. A bucket is one task's work, so
their number has to follow the rows (``buckets_for``). A hot key stays in its bucket: lay
such a table out by another key.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyward.functions.sql import literal, name
from tallyward.sources.versions import Versions

#: Rows that a bucket holds at most, keys dealt evenly: what a task sorts without spilling.
BUCKET_ROWS = 1_000_000


def buckets_for(tables: Iterable[DataFrame], least: int = 8) -> int:
    """As many buckets as the largest of the tables needs: ``least``, doubled until none holds too many rows."""
    most, buckets = max((df.count() for df in tables), default=0), least
    while buckets * BUCKET_ROWS < most:
        buckets *= 2
    return buckets


def write_buckets(df: DataFrame, root: str, table: str, keys: Sequence[str], buckets: int) -> None:
    """Write a table by its keys; readers see the old one until all of the new one is there."""
    if buckets < 1 or not keys:
        raise ValueError("a bucketed table needs keys and at least one bucket")
    spark = df.sparkSession
    versions = Versions(spark, root)
    path = versions.new_folder(table)
    made = f"written_{hashlib.md5(path.encode()).hexdigest()}"
    rows = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    rows.option("path", path).saveAsTable(made)
    # the files stay, as the table does not own them
    spark.sql(f"DROP TABLE {made}")
    entry = {"path": path, "keys": list(keys), "buckets": buckets, "schema": df.schema.json()}
    versions.commit(lambda version: version | {"tables": version.get("tables", {}) | {table: entry}})


@dataclass(frozen=True)
class Buckets:
    """A folder of tables that ``write_buckets`` wrote; their layout is read with them, never guessed."""

    root: str

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        found = Versions(spark, self.root).current().get("tables", {})
        if table not in found:
            raise KeyError(f"no bucketed table {table!r} under {self.root}; there are {sorted(found)}")
        entry = found[table]
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        columns = ", ".join(f"{name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(name(k) for k in entry["keys"])
        # the folder is another one for each version, so a registered table never goes stale
        known = f"bucketed_{hashlib.md5(entry['path'].encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {known} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {entry['buckets']} BUCKETS LOCATION {literal(entry['path'])}"
        )
        return spark.table(known)
