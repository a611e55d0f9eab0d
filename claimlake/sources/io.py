"""Layer tables, lookups, manifests and CSV exports.

Layout: ``{base}/{layer}/{dataset}`` Parquet, partitioned by YEAR for every
layer, so a yearly run reads and rewrites only its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake import schemas
from claimlake.functions.codes import remove_thousands
from claimlake.operators.store import read_store

LAYERS = ("bronze", "silver", "gold")


def layer_path(base: str, layer: str, dataset: str) -> str:
    if layer not in LAYERS and layer != "quarantine":
        raise ValueError(f"unknown layer {layer!r}")
    return f"{base.rstrip('/')}/{layer}/{dataset}"


def read_layer(spark: SparkSession, base: str, layer: str, dataset: str, year: int | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """A layer table; ``year`` becomes a partition filter (only that folder is
    listed and read). ``schema`` keeps partition values as typed there (a
    folder name like ``02`` would else be read as a number)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(layer_path(base, layer, dataset))
    return df.where(F.col("YEAR") == year) if year is not None else df


GOLD_DATASET = "markets"


def read_gold(spark: SparkSession, base: str, market: str, year: int | None = None) -> DataFrame:
    """A gold table, with its own columns. All of them lie in one stored table,
    by GOLD_TABLE and YEAR; only the folders asked for are read."""
    wanted = F.col("GOLD_TABLE") == market
    if year is not None:
        wanted &= F.col("YEAR") == year
    return read_store(spark, layer_path(base, "gold", GOLD_DATASET), wanted).select(*schemas.GOLD_COLUMNS[market], "UPDATE_DATE")


def _same_schema(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Raises if the table at ``path`` has other columns or types. Partition values
    are stored as text and have no type there."""
    try:
        old = df.sparkSession.read.parquet(path).schema
    except AnalysisException:
        return
    typed = lambda schema: {f.name: None if f.name in partition_by else f.dataType for f in schema.fields}
    want, have = typed(df.schema), typed(old)
    if want != have:
        raise ValueError(f"schema change at {path}: {sorted(set(want.items()) ^ set(have.items()), key=str)}")


def write_layer(df: DataFrame, base: str, layer: str, dataset: str, partition_by: Sequence[str] = ("YEAR",),
                allow_schema_change: bool = True) -> str:
    """Overwrite the partitions present in ``df`` (dynamic overwrite: other
    years stay). Rows are rebalanced by the partition columns so that a hot
    year is split over several writers instead of one.

    ``allow_schema_change=False`` first compares the new schema with the
    stored one (names and types) and raises on a difference."""
    path = layer_path(base, layer, dataset)
    if not allow_schema_change:
        _same_schema(df, path, partition_by)
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    return path


def write_year(df: DataFrame, base: str, layer: str, dataset: str, by: Sequence[str] = (), years: Sequence[int] | None = None,
               allow_schema_change: bool = False) -> str:
    """Replace whole years of ``{dataset}/YEAR=y[/by...]``: one dynamic
    overwrite writes the folders that the delivery has, then the folders of
    these years that it has not are emptied, so nothing of an earlier delivery
    stays. ``years`` are the years of the delivery, those in the data by default.

    A run that fails in between leaves new folders beside old ones: run again.
    """
    columns = ["YEAR", *by]
    new = {tuple(r) for r in df.select(columns).distinct().collect()}  # a row per folder
    years = {r[0] for r in new} if years is None else set(years)
    outside = {r[0] for r in new} - years
    if outside:
        raise ValueError(f"rows of years {outside} in a delivery of {years}")
    root = layer_path(base, layer, dataset)
    if not allow_schema_change:
        _same_schema(df, root, columns)
    try:
        old = {tuple(r) for r in df.sparkSession.read.schema(df.schema).parquet(root).select(columns).distinct().collect()}
    except AnalysisException:
        old = set()
    write_layer(df, base, layer, dataset, columns)
    for folder in sorted((r for r in old - new if r[0] in years), key=str):
        name = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(columns, folder, strict=True))
        df.limit(0).drop(*columns).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{name}")
    return root


def read_lookup(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """A market definition or MME lookup delivered as CSV (header) or Parquet,
    read with a fixed schema (codes stay strings: no inference)."""
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unsupported lookup format {fmt!r} (workbook and SAS files are converted upstream)")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Raw delivery manifest CSV: FileName + 'RecordCount(With Header Record)', all strings."""
    return spark.read.schema(schemas.MANIFEST_RAW_SCHEMA).option("header", True).csv(path)


def parse_manifest(raw: DataFrame, name_col: str = "FileName",
                   count_col: str = "RecordCount(With Header Record)") -> DataFrame:
    """``OPI_FactRx_201501.txt`` -> MARKET opi, DATA_TYPE factrx, MONTH_ID
    201501; ``1,234`` -> 1234. A name without a month part gives NULL
    MONTH_ID; a malformed count gives NULL."""
    parts = F.split(F.col(name_col), "_")
    stem = lambda i: F.split(F.get(parts, i), r"\.").getItem(0)
    return raw.select(
        F.lower(F.get(parts, 0)).alias("MARKET"),
        F.lower(stem(1)).alias("DATA_TYPE"),
        stem(2).alias("MONTH_ID"),
        remove_thousands(F.col(count_col)).try_cast("int").alias("RECORD_COUNT"),
    )


def export_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ("YEAR",), single_file: bool = False,
               drop: Sequence[str] = ()) -> str:
    """Headered CSV export, one folder per partition value.

    Default: rows are rebalanced by the partition columns (AQE splits a hot
    partition over several files). ``single_file=True`` writes exactly one
    file per partition value, in one task each: only for partitions known to
    be small.
    """
    out = df.drop(*drop)
    if partition_by:
        out = out.repartition(*partition_by) if single_file else out.hint("rebalance", *partition_by)
    # Keep values exactly (a blank flag stays a blank, not an empty field).
    # Other partitions (years exported before) stay, whatever the session's overwrite mode.
    writer = (out.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False).option("partitionOverwriteMode", "dynamic").mode("overwrite"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an export back with its schema (CSV keeps no types)."""
    return spark.read.schema(schema).option("header", True).csv(path)
