"""A large table and its lookup stored by the same key in the same number of
buckets, so that joining them moves neither, at every run after the first.

``{path}/keyed`` is a Spark bucketed table. Rows that buckets would pile up lie
beside it in ``{path}/apart``, in no order: rows with a NULL in their key, which
match nothing, and rows of keys that hold more than a quarter of a bucket's fair
share. There are at most four such keys a bucket (``{path}/hot``), so the part of
the lookup that they need is small and is broadcast after a check of its size.

``{path}/_colocated`` keeps the key, the number of buckets and the schema: a
session without the catalog entry makes it anew from the files. Storing a path
again replaces the table.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.codes import merge_flag
from claimlake.operators.relate import DEFAULT_BROADCAST_MAX_ROWS, left_join_flag

#: A key with more rows than a bucket's fair share divided by this lies apart.
HOT_PARTS = 4
#: Rows of a bucket, which one task sorts: a larger table gets more buckets than asked for.
ROWS_PER_BUCKET = 500_000
_NOTE = "buckets int, keys string, schema string"


@dataclass(frozen=True)
class Colocated:
    """A stored table: ``keyed`` by buckets, ``apart`` without order, its hot keys."""

    keys: tuple[str, ...]
    buckets: int
    keyed: DataFrame
    apart: DataFrame
    hot: DataFrame

    def rows(self) -> DataFrame:
        return self.keyed.unionByName(self.apart)

    def where(self, condition: Column) -> Colocated:
        return replace(self, keyed=self.keyed.where(condition), apart=self.apart.where(condition))

    def select(self, *columns: str) -> Colocated:
        """These columns; the keys must be among them."""
        return replace(self, keyed=self.keyed.select(*columns), apart=self.apart.select(*columns))


def _name(path: str) -> str:
    return "colocated_" + hashlib.sha256(path.encode()).hexdigest()[:20]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def hot_keys(df: DataFrame, keys: Sequence[str], buckets: int, rows: int | None = None) -> DataFrame:
    """Keys with more rows than a ``HOT_PARTS``-th of a bucket's fair share: at most
    ``HOT_PARTS * buckets``. Counts start in each task, so a hot key moves as a row per task."""
    whole = df.dropna(subset=list(keys))
    bound = max(1, (whole.count() if rows is None else rows) // (HOT_PARTS * buckets))
    return whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).drop("n")


def store(df: DataFrame, path: str, keys: Sequence[str], buckets: int, lookup: bool = False) -> Colocated:
    """Store ``df`` by ``keys`` in ``buckets`` buckets, one file each (one shuffle), or in
    as many as keep ``ROWS_PER_BUCKET`` rows a bucket; a ``lookup`` is stored in exactly
    ``buckets``, those of the table it goes with. ``df`` is read several times and should be a stored table. A ``lookup`` holds about one row a key: none of its keys is hot, and its rows
    with a NULL key, which no row can meet, stay out."""
    spark, path = df.sparkSession, path.rstrip("/")
    missing = [k for k in keys if k not in df.columns]
    if missing or buckets < 1:
        raise ValueError(f"no columns {missing}" if missing else f"not a number of buckets: {buckets}")
    whole = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    none = df.select(*keys).limit(0)
    if not lookup:
        rows = df.where(whole).count()
        buckets = max(buckets, -(-rows // ROWS_PER_BUCKET))
    (none if lookup else hot_keys(df, keys, buckets, rows)).write.mode("overwrite").parquet(f"{path}/hot")
    hot = F.broadcast(spark.read.schema(none.schema).parquet(f"{path}/hot"))
    near = df.where(whole)
    if lookup:
        df.limit(0).write.mode("overwrite").parquet(f"{path}/apart")
    else:
        away = near.join(hot, list(keys), "left_semi").select(df.columns).unionByName(df.where(~whole))
        away.hint("rebalance").write.mode("overwrite").parquet(f"{path}/apart")
        near = near.join(hot, list(keys), "left_anti").select(df.columns)
    # Spark's hash partitions are its buckets: a task writes one file
    writer = near.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).option("path", f"{path}/keyed")
    writer.saveAsTable(_name(path), format="parquet")
    note = {"buckets": buckets, "keys": json.dumps(list(keys)), "schema": df.schema.json()}
    spark.range(1).select(*[F.lit(v).alias(k) for k, v in note.items()]).coalesce(1).write.mode("overwrite").json(f"{path}/_colocated")
    return read(spark, path)


def read(spark: SparkSession, path: str) -> Colocated:
    """The table stored at ``path``."""
    path = path.rstrip("/")
    try:
        note = spark.read.schema(_NOTE).json(f"{path}/_colocated").first()
    except AnalysisException:
        note = None
    if note is None:
        raise ValueError(f"no table by buckets at {path}")
    keys, schema = tuple(json.loads(note["keys"])), T.StructType.fromJson(json.loads(note["schema"]))
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(map(_quoted, keys))
        place = f"{path}/keyed".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {note['buckets']} BUCKETS LOCATION '{place}'")
    hot = spark.read.schema(T.StructType([schema[k] for k in keys])).parquet(f"{path}/hot")
    return Colocated(keys, note["buckets"], spark.table(name).select(*schema.names), spark.read.schema(schema).parquet(f"{path}/apart"), hot)


def left_join(left: Colocated, lookup: Colocated, flag: str, broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``left`` LEFT JOIN ``lookup`` on their keys, in order, with a 0/1 ``flag``.

    Keys of one name are those of ``left`` afterwards; of others both stay. Rows
    in buckets meet without an exchange; those apart meet the lookup's rows of
    their keys, broadcast if they fit. Other column names must differ."""
    if left.buckets != lookup.buckets or len(left.keys) != len(lookup.keys):
        raise ValueError(f"{left.buckets} buckets by {left.keys} do not meet {lookup.buckets} by {lookup.keys}")
    types = [(left.keyed.schema[a].dataType, lookup.keyed.schema[b].dataType) for a, b in zip(left.keys, lookup.keys, strict=True)]
    if any(a != b for a, b in types):
        raise ValueError(f"keys of other types are in other buckets: {types}")
    shared = set(left.keys) & set(lookup.keys)
    clash = (set(left.keyed.columns) & set(lookup.keyed.columns)) - shared
    if clash or flag in {*left.keyed.columns, *lookup.keyed.columns}:
        raise ValueError(f"columns on both sides: {sorted(clash) or [flag]}")
    names = {k: f"__lookup_{k}" for k in shared}
    there = [names.get(k, k) for k in lookup.keys]
    right = lookup.keyed.withColumnsRenamed(names)
    near = left.keyed
    same = functools.reduce(lambda a, b: a & b, [near[a] == right[b] for a, b in zip(left.keys, there, strict=True)])
    near = near.join(right, same, "left").withColumn(flag, merge_flag(F.col(there[0]))).drop(*names.values())

    hot = left.hot.toDF(*there)
    needed = right.join(F.broadcast(hot), there, "left_semi").select(right.columns)
    # one key column joins, the others are compared as well
    first, others = left.keys[0], list(left.keys[1:])
    needed = needed.withColumnsRenamed({b: a for a, b in zip(others, there[1:], strict=True)})
    kept = [F.col(a).alias(b) for a, b in zip(others, there[1:], strict=True) if b not in names.values()]
    away = left_join_flag(left.apart, needed.select("*", *kept) if kept else needed, first, there[0], flag, broadcast_max_rows=broadcast_max_rows, also=others)
    return near.unionByName(away.drop(*names.values()))
