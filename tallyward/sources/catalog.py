"""Named sources: the same table names, kept in one or several places."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.frames import union_all
from tallyward.sources.buckets import Buckets
from tallyward.sources.inference import typed
from tallyward.sources.schemas import SCHEMAS


@dataclass(frozen=True)
class Split:
    """How a database table is read by several tasks: ranges of a whole-number or date column."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class Cuts:
    """How a database table is read by several tasks: ranges that hold about equally many rows.

    ``cuts`` are the ascending values at which a range begins; a value of ``hot`` is a task
    of its own, and so are nulls if there may be any.
    """

    column: str
    cuts: tuple = ()
    hot: tuple = ()
    nulls: bool = True

    def predicates(self) -> list[str]:
        """One condition per task; every row meets exactly one."""
        c, hot = self.column, sorted(set(self.hot))
        cuts = sorted(set(self.cuts))
        rest = f" AND {c} NOT IN ({', '.join(_sql_value(v) for v in hot)})" if hot else ""
        ranges = [f"{c} < {_sql_value(cuts[0])}"] if cuts else [f"{c} IS NOT NULL"]
        ranges += [f"{c} >= {_sql_value(low)} AND {c} < {_sql_value(high)}" for low, high in zip(cuts, cuts[1:])]
        ranges += [f"{c} >= {_sql_value(cuts[-1])}"] if cuts else []
        return [r + rest for r in ranges] + [f"{c} = {_sql_value(v)}" for v in hot] + ([f"{c} IS NULL"] if self.nulls else [])

    @classmethod
    def of(cls, keys: DataFrame, column: str, parts: int) -> Cuts:
        """Cuts at the quantiles of a key column, or of a sample of it.

        A value that fills a part alone is hot; there are no more of them than parts. The
        quantiles are those of the other rows.
        """
        counted = keys.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        rows, nulls = counted.agg(F.sum("_n"), F.count_if(F.col(column).isNull())).first()
        if not rows or parts < 2:
            return cls(column, nulls=bool(nulls))
        share = rows / parts
        hot = [r[0] for r in counted.filter((F.col("_n") >= share) & F.col(column).isNotNull()).select(column).collect()]
        others = keys.filter(F.col(column).isNotNull() & ~F.col(column).isin(hot))
        left = others.count()
        wanted = min(parts, round(left / share))
        kind = keys.schema[column].dataType.simpleString()
        at = ", ".join(str(k / wanted) for k in range(1, wanted))
        found = others.agg(F.expr(f"percentile_approx({_rank(column, kind)}, array({at}), 10000)")).first()[0] if at else []
        return cls(column, tuple(_from_rank(v, kind) for v in sorted(set(found or []))), tuple(hot), bool(nulls))


def _sql_value(value: object) -> str:
    """A number, date, time or text as standard SQL."""
    if isinstance(value, bool) or not isinstance(value, (int, Decimal, str, date)):
        raise TypeError(f"cannot split by {value!r}")
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _rank(column: str, kind: str) -> str:
    """The key as a number, of which quantiles can be taken."""
    if kind == "date":
        return f"unix_date(`{column}`)"
    if kind in ("timestamp", "timestamp_ntz"):
        return f"unix_micros(CAST(`{column}` AS TIMESTAMP))"
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return f"`{column}`"
    raise TypeError(f"cannot take quantiles of a {kind} column")


def _from_rank(value: int, kind: str) -> object:
    if kind == "date":
        return date(1970, 1, 1) + timedelta(days=value)
    return datetime(1970, 1, 1) + timedelta(microseconds=value) if kind.startswith("timestamp") else value


@dataclass(frozen=True)
class Files:
    """A folder with one dataset per table.

    ``name_format`` gives a table's path below the root. CSV files have a header
    row; their schema is taken from ``schemas``, and inferred for tables not named there.
    """

    root: str
    kind: str = "parquet"
    name_format: str = "{table}.parquet"
    schemas: Mapping[str, str] = field(default_factory=lambda: SCHEMAS)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        path = f"{self.root}/{self.name_format.format(table=table)}"
        if self.kind == "csv":
            return read_sheet(spark, path, self.schemas.get(table))
        return spark.read.format(self.kind).load(path)


@dataclass(frozen=True)
class Database:
    """A JDBC database; the caller supplies url, user, password and driver as options.

    ``schemas`` maps a table to its database schema; ``splits`` says how tables are read in
    parallel. A table that has no split is read by a single task, and only if it is named
    in ``small``.
    """

    options: Mapping[str, str]
    schemas: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split | Cuts] = field(default_factory=dict)
    small: Collection[str] = ()
    fetch_size: int = 10_000

    def reader_options(self, table: str, query: str | None = None, split: Split | Cuts | None = None) -> dict[str, str]:
        prefix = self.schemas.get(table)
        target = f"({query}) {table}" if query else f"{prefix}.{table}" if prefix else table
        chosen = split or self.splits.get(table)
        if chosen is None and table not in self.small:
            raise ValueError(f"{table!r} has no split, so one task would read it all; give one, or name it among the small ones")
        return {
            **self.options,
            "dbtable": target,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
            **(chosen.options() if isinstance(chosen, Split) else {}),
        }

    def _load(self, spark: SparkSession, options: dict[str, str], split: Split | Cuts | None) -> DataFrame:
        if not isinstance(split, Cuts):
            return spark.read.format("jdbc").options(**options).load()
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=split.predicates(), properties=rest)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self._load(spark, self.reader_options(table), self.splits.get(table))

    def query(self, spark: SparkSession, name: str, sql: str, split: Split | Cuts | None = None) -> DataFrame:
        return self._load(spark, self.reader_options(name, sql, split), split or self.splits.get(name))


class Sources:
    """Registry of named sources, ``main`` being the default.

    A registry opens each table once, so that a report reading one several times
    lists its files and fetches its schema only once.
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, Files | Database | Buckets]):
        self.spark = spark
        self._sources = dict(sources)
        self._opened: dict[tuple[str, str], DataFrame] = {}

    def table(self, name: str, source: str = "main") -> DataFrame:
        if source not in self._sources:
            raise KeyError(f"no source {source!r}; known: {sorted(self._sources)}")
        if (source, name) not in self._opened:
            self._opened[source, name] = self._sources[source].read(self.spark, name)
        return self._opened[source, name]

    def tables(self, names: Iterable[str], source: str = "main") -> dict[str, DataFrame]:
        return {name: self.table(name, source) for name in names}

    def across(self, names: Iterable[str], build: Callable[[str, dict[str, DataFrame]], DataFrame]) -> DataFrame:
        """Build the same report on every source and stack the results."""
        wanted = list(names)
        return union_all([build(source, self.tables(wanted, source)) for source in self._sources])


def read_sheet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A sheet exported as CSV with a header row; bad cells are errors, not nulls.

    Without a schema the types are inferred from all cells (``sources.inference``).
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return typed(reader.csv(path)) if schema is None else reader.schema(schema).csv(path)
