"""One schema over a table whose YEAR folders were written with different ones.

``year_schemas`` reads what each folder holds, ``plan`` finds for every column the
type that takes all years' values without loss, and ``read_years`` reads the whole
table through it: a column that a year lacks is NULL there, a narrower type is
widened. Types without such a common type are a conflict: an error, or with
``strict=False`` the column is read as text. YEAR values are read as they are
stored (``02`` stays ``02``).

The driver handles one schema per YEAR folder; rows are only read by ``read_years``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaConflict(ValueError):
    """Columns whose types in different years have no common type."""


@dataclass(frozen=True)
class Step:
    """What happens to one column of one year."""

    year: str
    column: str
    stored_type: str | None
    target_type: str
    status: str  # same, widened, added (the year before lacks it), missing, conflict


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrower of the types that hold every value of both exactly, None without one."""
    if a == b:
        return a
    whole = [x for x in (a, b) if isinstance(x, _WHOLE)]
    if len(whole) == 2:
        return max(whole, key=lambda x: _WHOLE.index(type(x)))
    if any(isinstance(x, T.DecimalType) for x in (a, b)) and all(isinstance(x, (T.DecimalType, *_WHOLE)) for x in (a, b)):
        sizes = [(_DIGITS[type(x)], 0) if isinstance(x, _WHOLE) else (x.precision - x.scale, x.scale) for x in (a, b)]
        left, right = (max(x) for x in zip(*sizes, strict=True))
        return T.DecimalType(left + right, right) if left + right <= 38 else None
    if any(isinstance(x, (T.FloatType, T.DoubleType)) for x in (a, b)):
        other = [x for x in (a, b) if not isinstance(x, (T.FloatType, T.DoubleType))]
        if not other or isinstance(other[0], T.IntegerType):
            return T.DoubleType()
        if isinstance(other[0], (T.ByteType, T.ShortType)):
            return next(x for x in (a, b) if x not in other)
        return None
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def year_schemas(spark: SparkSession, path: str, partition: str = "YEAR") -> dict[str, T.StructType]:
    """The data schema of every folder ``partition``=value, by stored value. A year
    is written whole, so one of its files tells. Files are listed, not opened, to find
    the folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    value = F.regexp_extract("path", f"/{partition}=([^/]+)/", 1).alias("value")
    years = sorted(r[0] for r in files.select(value).where("value <> ''").distinct().collect())
    return {y: spark.read.parquet(f"{path}/{partition}={y}").schema for y in years}


def plan(schemas: Mapping[str, T.StructType]) -> list[Step]:
    """One step for every year and column, columns in the order in which they first appear."""
    years = sorted(schemas)
    types = {y: {f.name: f.dataType for f in schemas[y].fields} for y in years}
    columns = list(dict.fromkeys(c for y in years for c in types[y]))
    clash = [c for c in columns if sum(c.lower() == d.lower() for d in columns) > 1]
    if clash:
        raise SchemaConflict(f"columns that differ in case only: {sorted(clash)}")
    steps = []
    for c in columns:
        target = reduce(lambda a, b: a and wider(a, b), [types[y][c] for y in years if c in types[y]])
        before = None
        for y in years:
            stored = types[y].get(c)
            if stored is None:
                status = "missing"
            elif target is None:
                status = "conflict"
            elif before is not None and c not in types[before]:
                status = "added"
            else:
                status = "same" if stored == target else "widened"
            steps.append(Step(y, c, stored.simpleString() if stored else None, target.simpleString() if target else "string", status))
            before = y
    return steps


def read_years(spark: SparkSession, path: str, partition: str = "YEAR", strict: bool = True) -> DataFrame:
    """All rows of all years in the planned schema, with ``partition`` as text."""
    steps = plan(year_schemas(spark, path, partition))
    conflicts = sorted({s.column for s in steps if s.status == "conflict"})
    if conflicts and strict:
        found = {c: {s.year: s.stored_type for s in steps if s.column == c} for c in conflicts}
        raise SchemaConflict(f"no common type over the years: {found}")
    if not steps:
        raise ValueError(f"no {partition} folders in {path}")
    parts = []
    for year in sorted({s.year for s in steps}):
        own = [s for s in steps if s.year == year]
        columns = [(F.col(f"`{s.column}`") if s.stored_type else F.lit(None)).cast(s.target_type).alias(s.column) for s in own]
        parts.append(spark.read.parquet(f"{path}/{partition}={year}").select(*columns, F.lit(year).alias(partition)))
    return reduce(DataFrame.union, parts)


def report(spark: SparkSession, path: str, partition: str = "YEAR") -> DataFrame:
    """(year, column, stored_type, target_type, status, filled) for every year and
    column; ``filled`` counts its non-NULL values, in one aggregation over the table."""
    steps = plan(year_schemas(spark, path, partition))
    rows = [(s.year, s.column, s.stored_type, s.target_type, s.status) for s in steps]
    planned = spark.createDataFrame(rows, "year string, column string, stored_type string, target_type string, status string")
    df = read_years(spark, path, partition, strict=False)
    names = [c for c in df.columns if c != partition]
    counted = df.groupBy(F.col(partition).alias("year")).agg(F.array(*[F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{c}`")).alias("filled")) for c in names]).alias("items"))
    filled = counted.select("year", F.inline("items"))
    return planned.join(filled, ["year", "column"], "left").select(*planned.columns, F.coalesce("filled", F.lit(0)).alias("filled"))
