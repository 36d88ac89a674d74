"""Writing reports: one dataset per sheet, in folders named after the report's parameters."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Sheet = DataFrame | Callable[[dict[str, DataFrame]], DataFrame]

#: Rows up to which a sheet may be written by a single task.
SINGLE_FILE_ROWS = 1_000_000

_ROW = "_row_of_sheet"
# Times keep their microseconds, texts their outer blanks.
_CSV = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "escape": '"',
}


def report_path(base: str, template: str, **params: object) -> str:
    """``base`` plus a folder name such as ``{level}-{grain}-payments`` with its parameters filled in."""
    name = template.format(**params)
    if "/" in name or name in ("", ".", ".."):
        raise ValueError(f"report name {name!r} is not a folder name")
    return f"{base.rstrip('/')}/{name}"


def write_report(
    sheets: Mapping[str, Sheet],
    base: str,
    kind: str = "parquet",
    partition_by: Collection[str] = (),
    single_file: Collection[str] = (),
    replaces: Mapping[str, object] | None = None,
) -> dict[str, int]:
    """Write every sheet to ``base/sheet=<name>`` and return the rows written per sheet.

    A sheet may be a function of the sheets written before it. It then reads the written
    data: a base list shared by two sheets is computed once, and a lost executor does not
    cost the work again. What is read back has no order; a sheet that needs one sorts.

    With ``partition_by`` only the partitions that the new rows belong to are replaced, so
    earlier periods stay. ``replaces`` names one partition, such as ``{"period_start":
    "2021-03-01", "period_end": "2021-03-31"}``, that is emptied if there are no new rows.

    CSV is an export: a Parquet copy under ``base/_copies`` is written first, and other
    sheets read that. In texts of a CSV sheet, a backslash is written as two, line breaks
    as ``\\n`` and ``\\r``; ``read_export`` undoes that. Sheets in ``single_file``, of up to
    ``SINGLE_FILE_ROWS`` rows, become one file; their rows are computed by all tasks and
    only written by one, in their order.
    """
    written: dict[str, DataFrame] = {}
    rows: dict[str, int] = {}
    base = base.rstrip("/")
    for name, sheet in sheets.items():
        frame = sheet if isinstance(sheet, DataFrame) else sheet(written)
        path, single = f"{base}/sheet={name}", name in single_file
        if kind == "csv" or single:
            numbered = frame.withColumn(_ROW, F.monotonically_increasing_id())
            rows[name], copy = _saved(numbered, f"{base}/_copies/sheet={name}")
            if single and rows[name] > SINGLE_FILE_ROWS:
                raise ValueError(f"sheet {name!r} has {rows[name]} rows, too many for a single file")
            out = copy.repartition(1).sortWithinPartitions(_ROW) if single else copy.orderBy(_ROW)
            out = out.drop(_ROW)
            _write(_escaped(out) if kind == "csv" else out, path, kind, partition_by)
            written[name] = copy.drop(_ROW)
        else:
            rows[name], written[name] = _saved(frame, path, kind, partition_by)
        if partition_by and replaces and not rows[name]:
            _remove(frame.sparkSession, path, partition_by, replaces)
    return rows


def _write(frame: DataFrame, path: str, kind: str, partition_by: Collection[str] = ()) -> None:
    writer = frame.write.mode("overwrite").format(kind)
    if kind == "csv":
        writer = writer.options(**_CSV)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def _saved(
    frame: DataFrame, path: str, kind: str = "parquet", partition_by: Collection[str] = ()
) -> tuple[int, DataFrame]:
    """Rows written, counted by the write itself, and the data as read back."""
    seen = Observation()
    _write(frame.observe(seen, F.count(F.lit(1)).alias("rows")), path, kind, partition_by)
    return seen.get["rows"], frame.sparkSession.read.schema(frame.schema).format(kind).load(path)


def _remove(spark: SparkSession, path: str, columns: Collection[str], values: Mapping[str, object]) -> None:
    """Delete one partition's folder, if it is there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{c}={values[c]}" for c in columns]]))
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _texts(frame: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    names = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    return frame.withColumns({n: change(F.col(f"`{n}`")) for n in names}) if names else frame


def _escaped(frame: DataFrame) -> DataFrame:
    def change(text: Column) -> Column:
        for plain, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(plain), F.lit(shown))
        return F.when(text == "", F.lit("\\e")).otherwise(text)

    return _texts(frame, change)


def read_export(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A CSV sheet that ``write_report`` wrote, with the texts it was given."""

    def change(text: Column) -> Column:
        # a letter after an even number of backslashes is itself; \u0000 keeps double backslashes apart meanwhile
        kept = F.replace(text, F.lit("\\\\"), F.lit("\u0000"))
        for plain, shown in (("\n", "\\n"), ("\r", "\\r"), ("\\", "\u0000")):
            kept = F.replace(kept, F.lit(shown), F.lit(plain))
        return F.when(text == "\\e", F.lit("")).otherwise(kept)

    return _texts(spark.read.schema(schema).options(**_CSV).csv(path), change)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows, for a look."""
    return df.limit(n)
