"""Keyed upsert into a YEAR-partitioned Parquet table.

Semantics of ``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``:
a target row whose key equals a source key is replaced, new keys are
inserted, target rows absent from the source stay. Keys compare with ``=``,
so a NULL key never matches (such rows are inserted again on each run). The
same CLAIM_ID in another YEAR is another row.

Built as ``(target restricted to the touched years) LEFT ANTI source-keys
UNION ALL source`` and written with dynamic partition overwrite, so only the
touched YEAR folders are replaced. For a large delivery only keys move: they find
the places (file, row) of the stored rows that it replaces, which go as bitmaps to
the tasks that read the files; the other stored rows are written where they are read. Spark writes the new files to a staging
folder inside the table and moves them in at job commit, after every task
(retries included) has read the old files. A job that fails before that leaves
the table as it was; the commit itself replaces year folders one by one, so a
driver lost in the middle of it can leave some years old, new or missing:
deliver again to recover. (A static overwrite of a path the plan reads would delete the input
first; it is never used here.) Single writer per table: two concurrent upserts into one table
are not isolated from each other (there is no transaction log).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from claimlake.operators.relate import assert_unique, bounded_broadcast, dedupe_latest, duplicate_keys, fits_broadcast, null_salt
from claimlake.session import materialize, sparing_disk

#: A delivery of at most so many rows has its keys sent to the stored rows, which then
#: move once, to their files.
SMALL_DELTA_ROWS = 500_000
#: For a larger one the places of the rows that it replaces are sent to the files, a bitmap of
#: 4 KB for each 32,768 rows of a file and so many at most (64 MB). The stored rows of a table
#: above that move by key to the delivery's, and are written there.
MAX_BITMAPS = 16_384
#: Of the table's files and of sources that are stored.
CODEC = "zstd"
#: Where a stored row lies.
PLACE = ("__file", "__row")


def table_exists(spark: SparkSession, path: str, schema: StructType | None = None) -> bool:
    """True when ``path`` holds a Parquet table. Without ``schema`` a folder
    without data files is not a table; with it, the folder's existence is
    enough (an empty table merges like any other) and no footer is read."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        reader.parquet(path).schema
    except AnalysisException:
        return False
    return True


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 partition_by: str | None = "YEAR", join: str | None = None) -> DataFrame:
    """The upserted content of the touched partitions (pure DataFrame, no
    write). Target rows with a NULL partition value belong to the partition of
    NULLs and stay like others. ``join`` is the hint (``broadcast``, ``merge``)
    for the source's keys, by default Spark's choice. A target that has the
    ``PLACE`` of its rows is not joined by key: the places of the rows that go are."""
    keys = list(keys)
    columns = [c for c in target.columns if c not in PLACE]
    missing = [c for c in columns if c not in source.columns]
    extra = [c for c in source.columns if c not in columns]
    retyped = [c for c in columns if c in source.columns and target.schema[c].dataType != source.schema[c].dataType]
    if missing or extra or retyped:
        raise ValueError(f"source and table differ: missing {missing}, extra {extra}, other types {retyped}")
    if partition_by:
        touched = source.select(F.col(partition_by).alias("__touched")).distinct()
        some, nulls = touched.where("__touched IS NOT NULL"), touched.where("__touched IS NULL")
        some, _ = bounded_broadcast(some)
        # the equality lets Spark prune partitions; NULL is asked for by itself
        target = target.join(some, target[partition_by] == some["__touched"], "left_semi").unionByName(
            target.where(F.col(partition_by).isNull()).withColumn("__touched", F.lit(0))
            .join(F.broadcast(nulls.select(F.lit(0).alias("__touched"))), "__touched", "left_semi").drop("__touched"))  # one row
    whole = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    src_keys = source.select(*keys).where(whole)
    if len(columns) < len(target.columns):
        replaced = target.select(*keys, *PLACE).where(whole).join(src_keys.hint(join) if join else src_keys, keys, "left_semi")
        kept = _marked(target, replaced).where("NOT __marked").select(*columns)
    else:
        src_keys = src_keys.withColumn("__salt", F.lit(0))
        if join:
            src_keys = src_keys.hint(join)
        left = target.withColumn("__salt", null_salt(keys, columns))
        kept = left.join(src_keys, [*keys, "__salt"], "left_anti").select(*columns)
    return kept.unionByName(source.select(*columns))


def _marked(target: DataFrame, found: DataFrame) -> DataFrame:
    """``target`` with ``__marked``: whether a row lies at a place of ``found``."""
    bucket = F.bitmap_bucket_number("__row").alias("__bucket")
    bits = found.groupBy("__file", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__row")).alias("__bits"))
    left = target.select("*", bucket, F.bitmap_bit_position("__row").cast("int").alias("__bit")).join(F.broadcast(bits), ["__file", "__bucket"], "left")
    byte = F.conv(F.hex(F.expr("substring(__bits, __bit div 8 + 1, 1)")), 16, 10).cast("int")
    return left.withColumn("__byte", byte).withColumn("__marked", F.expr("__bits IS NOT NULL AND (shiftright(__byte, __bit % 8) & 1) = 1"))


def _placed(target: DataFrame) -> DataFrame | None:
    """A stored table with the ``PLACE`` of its rows; None if that takes more than ``MAX_BITMAPS``
    bitmaps, or if two files have the same hash."""
    rows = target.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    rows = rows.withColumn("__file", F.xxhash64("__path"))
    found = rows.groupBy("__path", "__file", F.bitmap_bucket_number("__row").alias("__bucket")).agg(F.count(F.lit(1)).alias("n"))
    got = found.agg(F.count(F.lit(1)).alias("bitmaps"), F.count_distinct("__path").alias("files"), F.count_distinct("__file").alias("hashes")).first()
    return rows.drop("__path") if got["bitmaps"] <= MAX_BITMAPS and got["files"] == got["hashes"] else None


def _latest(source: DataFrame, keys: Sequence[str], latest: str | None) -> DataFrame | None:
    """What ``assert_unique`` keeps as ``latest`` of a large source that is read from stored files:
    keys move to find those that repeat, and then only these keys' rows. None for other sources."""
    keys = list(keys)
    if latest not in source.columns or fits_broadcast(source.select(*keys), SMALL_DELTA_ROWS):
        return None
    try:
        placed = _placed(source)
    except AnalysisException:  # not read from files as it is
        return None
    if placed is None:
        return None
    whole = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = duplicate_keys(source.where(whole), keys).select(*keys).hint("merge")
    marked = _marked(placed, placed.select(*keys, *PLACE).where(whole).join(repeated, keys, "left_semi"))
    again = dedupe_latest(marked.where("__marked").select(*source.columns), keys, latest)
    return marked.where("NOT __marked").select(*source.columns).unionByName(again)


def stored(spark: SparkSession, path: str, like: StructType) -> DataFrame:
    """The table with its own columns; partition values as typed in ``like``
    (folder names carry no type). An empty table has the columns of ``like``."""
    try:
        own = spark.read.parquet(path).schema
    except AnalysisException:
        return spark.read.schema(like).parquet(path)
    typed = {f.name: f.dataType for f in like.fields}
    # partition columns come last in the schema that is read
    fields = [StructField(f.name, typed.get(f.name, f.dataType) if f.name == own.fields[-1].name else f.dataType) for f in own.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str] = ("CLAIM_ID", "YEAR"),
           partition_by: str = "YEAR", on_duplicate: str = "error", num_partitions: int | None = None,
           stage_source: bool = True, latest: str | None = None) -> str:
    """Upsert ``source`` into the table at ``path`` (created when missing).

    ``on_duplicate``: ``error`` raises if the source repeats a key; ``latest``
    keeps the row with the greatest ``latest`` column; ``keep`` accepts several
    source rows per key (all are written, all replace the target rows of that
    key, which keeps re-runs idempotent). The source must have the table's
    columns and types.
    ``num_partitions`` only shapes the first load (must be >= 1); other
    writes move a row once at most: a write whose rows have moved by key already,
    or are read from a stored table, goes to its years from there, with a file a
    task and year. Shuffled rows are deleted after each write. ``stage_source=False`` skips storing the source first, for sources that are a
    cheap read of a stored table (the merge reads the source four times); what
    ``latest`` keeps of them is stored, and found by moving the rows of repeated keys only.
    """
    if num_partitions is not None and num_partitions < 1:
        raise ValueError("Number of partitions must be greater than or equal to 1.")
    one = _latest(source, keys, latest) if on_duplicate == "latest" and not stage_source else None
    source = assert_unique(source, keys, on_duplicate, latest) if one is None else one
    writer_opts = {"partitionOverwriteMode": "dynamic", "compression": CODEC}
    if not table_exists(spark, path, source.schema):
        if num_partitions:
            out = source.repartition(num_partitions)
        else:
            out = source if on_duplicate == "latest" or not stage_source else source.hint("rebalance", partition_by)
        with sparing_disk(spark):
            out.write.mode("overwrite").options(**writer_opts).partitionBy(partition_by).parquet(path)
        return path
    # The source is computed once and stored: the touched years, the keys
    # for the anti join and the inserted rows all read the stored copy.
    if stage_source or on_duplicate == "latest":
        with sparing_disk(spark):
            source = materialize(source, "upsert-source", codec=CODEC)
    target = stored(spark, path, source.schema)
    small = fits_broadcast(source.select(*keys), SMALL_DELTA_ROWS)
    placed = None if small else _placed(target)
    merged = merge_frames(target if placed is None else placed, source, keys, partition_by, "broadcast" if small else "merge")
    with sparing_disk(spark):
        ((merged.hint("rebalance", partition_by) if small else merged).write.mode("overwrite").options(**writer_opts)
         .partitionBy(partition_by).parquet(path))
    return path
