"""Row filters and column-shape operators (DataFrame -> DataFrame)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.codes import differs_or_null, in_or_null, safe_cast


def cast_types(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Cast the named columns; malformed values become NULL (never an error)."""
    return df.withColumns({c: safe_cast(c, t) for c, t in types.items() if c in df.columns})


def cast_rejects(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """One row: per column, how many non-NULL values a cast turns into NULL."""
    aggs = [
        F.count_if(F.col(c).isNotNull() & safe_cast(c, t).isNull()).alias(c)
        for c, t in types.items()
        if c in df.columns
    ]
    return df.agg(*aggs)


def rejected_cells(df: DataFrame, types: Mapping[str, T.DataType | str], keys: Iterable[str], table: str) -> DataFrame:
    """(table, keys, column_name, raw_value): every value that a cast turns into
    NULL, in one pass over the rows and without a shuffle."""
    cells = [
        F.when(F.col(c).isNotNull() & safe_cast(c, t).isNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("raw_value")))
        for c, t in types.items()
        if c in df.columns
    ]
    found = F.explode(F.array_compact(F.array(*cells))).alias("cell")
    return df.select(F.lit(table).alias("table_name"), *keys, found).select("table_name", *keys, "cell.column_name", "cell.raw_value")


def exclude_value(df: DataFrame, c: str, value, keep_null: bool = True) -> DataFrame:
    """Drop rows equal to ``value``; NULL rows stay unless ``keep_null`` is False."""
    cond = differs_or_null(c, value) if keep_null else (F.col(c) != F.lit(value))
    return df.where(cond)


def keep_in(df: DataFrame, c: str, values: Iterable, keep_null: bool = True) -> DataFrame:
    """Keep rows whose value is in ``values`` (and NULL rows unless ``keep_null`` is False)."""
    values = list(values)
    cond = in_or_null(c, values) if keep_null else F.col(c).isin(values)
    return df.where(cond)


def outside(df: DataFrame, c: str, values: Iterable) -> DataFrame:
    """Rows with a non-NULL value not in ``values`` (``NOT IN``: NULL drops out)."""
    return df.where(~F.col(c).isin(list(values)))


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name; two names that collide raise a ValueError."""
    seen: dict[str, str] = {}
    for c in df.columns:
        u = c.upper()
        if u in seen:
            raise ValueError(f"columns {seen[u]!r} and {c!r} both become {u!r}")
        seen[u] = c
    return df.toDF(*[c.upper() for c in df.columns])


def conform(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Project to a fixed column list, raising when a column is missing."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def align_variant(df: DataFrame, fill: Mapping[str, tuple[object, T.DataType | str]]) -> DataFrame:
    """Add constant columns (value, type) that one input variant lacks."""
    add = {c: F.lit(v).cast(t) for c, (v, t) in fill.items() if c not in df.columns}
    return df.withColumns(add) if add else df


def stamp(df: DataFrame, run_date: str | None = None, column: str = "UPDATE_DATE") -> DataFrame:
    """Audit column: the load date as a yyyy-MM-dd string.

    ``run_date`` makes the run reproducible; without it today's date is used.
    """
    value = F.lit(run_date) if run_date else F.date_format(F.current_date(), "yyyy-MM-dd")
    return df.withColumn(column, value.cast("string"))
