"""Reports whose sheets appear together or not at all."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyward.sources.reports import Sheet, _escaped, _saved, _write, read_export
from tallyward.sources.versions import Versions


def commit_report(
    spark: SparkSession,
    sheets: Mapping[str, Sheet],
    base: str,
    kind: str = "parquet",
    part: Mapping[str, object] | None = None,
) -> dict[str, int]:
    """Write all sheets aside, then show them at once; returns the rows per sheet.

    A reader sees the old sheets until the last one is written, and so after any failure.
    A sheet may be a function of the sheets written before it, as in ``write_report``.
    ``part`` names what the sheets cover, such as their period: they replace what an earlier
    report said of the same part, and stand beside other parts. Without it a sheet is replaced
    whole. Sheets that are not given stay as they are.
    """
    versions = Versions(spark, base)
    written: dict[str, DataFrame] = {}
    entries: dict[str, dict] = {}
    for name, sheet in sheets.items():
        frame = sheet if isinstance(sheet, DataFrame) else sheet(written)
        path = versions.new_folder("sheet")
        rows, written[name] = _saved(frame, path)
        if kind == "csv":
            path = versions.new_folder("sheet")
            _write(_escaped(written[name]), path, kind)
        entries[name] = {"path": path, "rows": rows, "kind": kind, "schema": written[name].schema.json()}
    label = json.dumps({k: str(v) for k, v in (part or {}).items()}, ensure_ascii=False, sort_keys=True)

    def change(version: dict) -> dict:
        shown = version.setdefault("sheets", {})
        for name, entry in entries.items():
            kept = shown.get(name, {}) if part else {}
            if "{}" in kept:
                raise ValueError(f"sheet {name!r} was written without parts")
            shown[name] = kept | {label: entry}
        return version

    versions.commit(change)
    return {name: entry["rows"] for name, entry in entries.items()}


def report_parts(spark: SparkSession, base: str, sheet: str) -> dict[str, int]:
    """The parts of a sheet, as JSON text, and their rows."""
    return {label: entry["rows"] for label, entry in sorted(_entries(spark, base, sheet).items())}


def read_report(spark: SparkSession, base: str, sheet: str) -> DataFrame:
    """A sheet as of the newest commit, all parts together. What it reads stays whole while new reports are written."""

    def read(entry: Mapping) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if entry["kind"] == "csv":
            return read_export(spark, entry["path"], schema)
        return spark.read.schema(schema).format(entry["kind"]).load(entry["path"])

    return reduce(DataFrame.unionByName, [read(entry) for _, entry in sorted(_entries(spark, base, sheet).items())])


def _entries(spark: SparkSession, base: str, sheet: str) -> dict:
    found = Versions(spark, base).current().get("sheets", {})
    if sheet not in found:
        raise KeyError(f"no sheet {sheet!r} under {base}; there are {sorted(found)}")
    return found[sheet]
