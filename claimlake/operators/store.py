"""Keyed tables on a bucketed layout: a delta rewrites its buckets only.

``{path}/{partition columns}/BUCKET=b`` holds the rows whose key hashes to ``b``;
the number of buckets and the table's schema are fixed at its first load and
kept with it (``{path}/_layout``). A merge lists the folders that its source
touches, reads those, and replaces them in one dynamic partition overwrite, for
all values of the partition columns (tables, years) at once.

Semantics of ``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *`` as in
:mod:`claimlake.operators.upsert`: keys compare with ``=`` within their partition,
so a row with a NULL in its key matches nothing and is added. Such rows lie in a
folder of their own for each run (a negative BUCKET): no merge reads them, however
many there are, and a run repeated under the same name replaces what it added.

The touched folders are listed on the driver, as Spark lists a table's folders
anyway: partitions x buckets at most. One writer per table at a time; a failure
before the job commit leaves the table as it was, one in it is mended by
delivering again.
"""

from __future__ import annotations

import collections
import functools
import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.relate import assert_unique, dedupe_latest
from claimlake.session import materialize

BUCKET = "BUCKET"
#: A bucket's rows at the first load, which fixes the number of buckets if the caller doesn't.
ROWS_PER_BUCKET = 2_000_000
#: Rows of a folder that a task takes in a merge by version, about.
CHUNK_ROWS = 250_000
#: Into so many parts, by hash of the key, a folder is dealt at most; its delivered rows are counted in so many.
CHUNKS = 64
_LAYOUT = "buckets int, keys string, partition_by string, schema string"


@dataclass(frozen=True)
class Layout:
    """How a table is stored; ``schema`` is its rows' without BUCKET."""

    buckets: int
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    schema: T.StructType

    @property
    def folder(self) -> list[str]:
        return [*self.partition_by, BUCKET]

    @property
    def key(self) -> list[str]:
        """Columns that identify a row: the key within its partition."""
        return [*self.keys, *[c for c in self.partition_by if c not in self.keys]]

    @property
    def hashed(self) -> list[str]:
        """The key without its partition columns: BUCKET is its hash."""
        return [k for k in self.keys if k not in self.partition_by] or list(self.keys)

    @property
    def stored(self) -> T.StructType:
        own = [f for f in self.schema.fields if f.name not in self.partition_by]
        return T.StructType([*own, *[self.schema[c] for c in self.partition_by], T.StructField(BUCKET, T.LongType())])


def layout(spark: SparkSession, path: str) -> Layout | None:
    """The layout of the table at ``path``, None where there is none."""
    try:
        row = spark.read.schema(_LAYOUT).json(f"{path}/_layout").first()
    except AnalysisException:
        return None
    if row is None:
        return None
    return Layout(row["buckets"], tuple(row["keys"].split(",")), tuple(row["partition_by"].split(",")), T.StructType.fromJson(json.loads(row["schema"])))


def _create(spark: SparkSession, path: str, found: Layout) -> Layout:
    row = {"buckets": found.buckets, "keys": ",".join(found.keys), "partition_by": ",".join(found.partition_by), "schema": found.schema.json()}
    spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()]).coalesce(1).write.mode("error").json(f"{path}/_layout")
    return found


def whole_key(keys: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def bucketed(df: DataFrame, found: Layout, run: str | None = None) -> DataFrame:
    """Adds BUCKET: the hash of the key without its partition columns, or the
    run's own number where a part of the key is NULL."""
    own = -1 - int(hashlib.sha256((run or uuid.uuid4().hex).encode()).hexdigest()[:15], 16)
    return df.withColumn(BUCKET, F.when(whole_key(found.key), F.pmod(F.xxhash64(*found.hashed), F.lit(found.buckets))).otherwise(F.lit(own)).cast("long"))


def _chunk(found: Layout, chunks: int) -> Column:
    """The part of its folder that a key lies in, told by another hash than BUCKET."""
    return F.pmod(F.hash(*found.hashed), F.lit(chunks))


def latest_by_folder(df: DataFrame, found: Layout, latest: str, chunks: int) -> DataFrame:
    """:func:`dedupe_latest` for rows that are written to their folders next: they move
    once, to a task for each part of a folder, and are sorted there by folder and key."""
    rest = [c for c in df.columns if c not in (*found.key, BUCKET)]
    order = [latest, *[c for c in rest if c != latest]]
    dealt = df.withColumn("__chunk", _chunk(found, chunks)).repartition(*found.folder, "__chunk")
    versions = Window.partitionBy(*found.folder, *[k for k in found.key if k not in found.folder], "__chunk").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return dealt.withColumn("__version", F.row_number().over(versions)).where(F.col("__version") == 1).select(*df.columns)


def in_folders(folders: Iterable[Row], found: Layout) -> Column:
    """The condition of lying in one of ``folders``, on partition columns alone, so
    that other folders are not opened."""
    groups: dict[tuple, set[int]] = {}
    for f in folders:
        groups.setdefault(tuple(f[c] for c in found.partition_by), set()).add(f[BUCKET])
    out = F.lit(False)
    for values, numbers in sorted(groups.items(), key=str):
        one = F.col(BUCKET).isin(sorted(numbers))
        for c, v in zip(found.partition_by, values, strict=True):
            one &= F.col(c).isNull() if v is None else F.col(c) == F.lit(v)
        out |= one
    return out


def read_store(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The table's rows; ``where`` on partition columns prunes folders."""
    found = layout(spark, path)
    if found is None:
        raise ValueError(f"no keyed table at {path}")
    df = spark.read.schema(found.stored).parquet(path)
    return (df if where is None else df.where(where)).select(*found.schema.names)


def _checked(df: DataFrame, found: Layout) -> None:
    want, have = {f.name: f.dataType for f in found.schema.fields}, {f.name: f.dataType for f in df.schema.fields if f.name != BUCKET}
    missing, extra = sorted(want.keys() - have.keys()), sorted(have.keys() - want.keys())
    retyped = sorted(c for c in want.keys() & have.keys() if want[c] != have[c])
    if missing or extra or retyped:
        raise ValueError(f"source and table differ: missing {missing}, extra {extra}, other types {retyped}")


def _empty(df: DataFrame, path: str, folder: Sequence[str], gone: Iterable[Row]) -> None:
    """Leaves no rows in folders that a merge has emptied (an overwrite replaces only folders it has rows for)."""
    for row in gone:
        name = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in folder)
        df.limit(0).drop(*folder).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{name}")


def merge_into(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str] = ("CLAIM_ID", "YEAR"),
               partition_by: Sequence[str] = ("YEAR",), buckets: int | None = None, on_duplicate: str = "error",
               latest: str | None = None, run: str | None = None, gone: DataFrame | None = None,
               staged: bool = False) -> str:
    """Merges ``source`` into the table at ``path``, made when missing.

    ``buckets`` holds for the first load: by default so many that the largest partition
    has ``ROWS_PER_BUCKET`` rows in each. Give the number for a table that grows from
    small deliveries, or deal it anew (:func:`rebucket`).
    ``on_duplicate``: ``error`` raises if the source repeats a key in a partition;
    ``keep`` writes all its rows, which replace the stored rows of their keys;
    ``latest`` keeps of all rows of a key, stored and delivered, the one with the greatest
    ``latest`` column (ties by all other columns), so deliveries may come in any
    order or twice. ``gone`` names rows to delete: keys and, if it has the ``latest``
    column, only rows that are no later. ``staged`` says that the source is a cheap
    read of stored rows that are not in this table."""
    if buckets is not None and buckets < 1:
        raise ValueError("Number of buckets must be greater than or equal to 1.")
    found = layout(spark, path)
    fresh = found is None
    if fresh and buckets is None:
        if not staged:
            source, staged = materialize(source, "store-source"), True
        buckets = -(-(source.groupBy(*partition_by).count().agg(F.max("count")).first()[0] or 1) // ROWS_PER_BUCKET)
    if fresh:
        found = _create(spark, path, Layout(buckets, tuple(keys), tuple(partition_by), T.StructType([f for f in source.schema.fields if f.name != BUCKET])))
    if (found.keys, found.partition_by) != (tuple(keys), tuple(partition_by)):
        raise ValueError(f"the table has keys {found.keys} and partitions {found.partition_by}")
    _checked(source, found)
    if on_duplicate != "latest":
        source = assert_unique(source, found.key, on_duplicate)
    elif latest not in found.schema.names:
        raise ValueError(f"on_duplicate='latest' needs the column that says which row is latest, got {latest!r}")
    source = bucketed(source.select(*found.schema.names), found, run)
    if not staged:
        source = materialize(source, "store-source")
    if on_duplicate == "latest":
        counted = source.groupBy(*found.folder, _chunk(found, CHUNKS).alias("__chunk")).count().collect()  # CHUNKS rows per folder at most
        touched = list({Row(**{c: r[c] for c in found.folder}) for r in counted})
    else:
        touched = source.select(*found.folder).distinct().collect()  # a row per folder
    stored = spark.read.schema(found.stored).parquet(path)
    hit: list[Row] = []
    if fresh:
        gone = None  # nothing is stored that it could delete
    if gone is not None:
        gone = materialize(bucketed(gone, found).where(F.col(BUCKET) >= 0), "store-gone")
        # an existing folder is opened only if its key hash occurs among the rows to delete
        reached = gone.select(*found.folder).distinct().collect()
        hit = _deleted(stored.where(in_folders(reached, found)), gone, found, latest).select(*found.folder).distinct().collect()
        touched = list({*touched, *hit})
    target = stored.where(in_folders([f for f in touched if f[BUCKET] >= 0], found))
    kept = target
    if gone is not None:
        kept = _deleted(kept, gone, found, latest, "left_anti")
    columns = [*found.schema.names, BUCKET]
    mine, unkeyed = source.where(F.col(BUCKET) >= 0).select(*columns), source.where(F.col(BUCKET) < 0).select(*columns)
    if on_duplicate == "latest":
        if _hot(counted, found):  # reduced where it lies, so a key's rows don't move into one task
            mine = dedupe_latest(mine, [*found.key, BUCKET], latest)
        rows = kept.select(*columns).unionByName(mine)
        out = latest_by_folder(rows, found, latest, _chunks(counted, [] if fresh else target.groupBy(*found.folder).count().collect(), found))
        if any(f[BUCKET] < 0 for f in touched):
            out = out.unionByName(unkeyed.hint("rebalance", *found.folder))
    elif fresh:
        out = mine.unionByName(unkeyed).hint("rebalance", *found.folder)  # nothing to meet
    else:
        # a small delta's keys are sent, larger ones shuffled, by Spark's choice at run time
        met = kept.join(mine.select(*found.key, BUCKET).distinct(), [*found.key, BUCKET], "left_anti").select(*columns)
        out = met.unionByName(mine).unionByName(unkeyed).hint("rebalance", *found.folder)
    # seen before the write: what the deletions leave without a row
    left = {tuple(r) for r in kept.select(*found.folder).distinct().collect()} | {tuple(f) for f in source.select(*found.folder).distinct().collect()} if hit else set()
    if touched:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*found.folder).parquet(path)
    _empty(spark.read.schema(found.stored).parquet(path), path, found.folder, [f for f in hit if tuple(f) not in left])
    return path


def _hot(counted: list[Row], found: Layout) -> bool:
    """Whether a key may hold so many of the delivered rows that it makes a part of its folder too large."""
    size = _sizes(counted, found)
    return any(r["count"] > max(CHUNK_ROWS, 4 * size[tuple(r[c] for c in found.folder)] / CHUNKS) for r in counted if r[BUCKET] >= 0)


def _chunks(counted: list[Row], stored: list[Row], found: Layout) -> int:
    """Into how many parts folders are dealt, so that the largest has about ``CHUNK_ROWS`` rows in each."""
    size = _sizes([r for r in [*counted, *stored] if r[BUCKET] >= 0], found)
    return min(CHUNKS, -(-max(size.values(), default=1) // CHUNK_ROWS))


def _sizes(counted: list[Row], found: Layout) -> collections.Counter:
    out: collections.Counter = collections.Counter()
    for r in counted:
        out[tuple(r[c] for c in found.folder)] += r["count"]
    return out


def _deleted(target: DataFrame, gone: DataFrame, found: Layout, latest: str | None, how: str = "left_semi") -> DataFrame:
    """Rows of ``target`` that ``gone`` names (or, with ``left_anti``, all others)."""
    on = [c for c in [*found.key, BUCKET] if c in gone.columns]
    versioned = latest is not None and latest in gone.columns
    # of a key's rows to delete the latest is enough
    named = gone.groupBy(*on).agg(*([F.max(latest).alias("__to")] if versioned else [F.lit(1).alias("__to")]))
    named = named.withColumnsRenamed({c: f"__{c}" for c in on})
    same = functools.reduce(lambda a, b: a & b, [target[c] == named[f"__{c}"] for c in on])
    if versioned:
        same = same & (target[latest].isNull() | (target[latest] <= named["__to"]))
    return target.join(named, same, how)


def rebucket(spark: SparkSession, path: str, to: str, buckets: int) -> str:
    """The table at ``path`` written to ``to`` with another number of buckets; rows
    with a NULL in their key stay in the folders of their runs."""
    old = layout(spark, path)
    if old is None:
        raise ValueError(f"no keyed table at {path}")
    new = _create(spark, to, Layout(buckets, old.keys, old.partition_by, old.schema))
    rows = spark.read.schema(old.stored).parquet(path)
    dealt = bucketed(rows.withColumn("__run", F.col(BUCKET)), new)
    dealt = dealt.withColumn(BUCKET, F.when(F.col("__run") < 0, F.col("__run")).otherwise(F.col(BUCKET))).drop("__run")
    dealt.hint("rebalance", *new.folder).write.mode("append").partitionBy(*new.folder).parquet(to)
    return to
