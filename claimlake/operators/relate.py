"""Lookup joins, unmatched-key extracts and deterministic de-duplication."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.codes import merge_flag

# Lookups (product, market definitions, MME) hold one row per code: a few
# hundred thousand at most. A lookup is broadcast only when a bounded job has
# counted at most this many rows and about this many bytes; otherwise the join
# shuffles.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# NULL join keys never match; they are spread over this many salt values so
# that they do not all land in one shuffle partition.
NULL_KEY_SALTS = 64


def _row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory bytes of a row: string/binary lengths plus fixed widths."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        name = f.dataType.typeName()
        if name in ("string", "binary"):
            size = F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 8
        elif name in ("integer", "date", "float"):
            size = F.lit(4)
        elif name in ("long", "double", "timestamp", "timestamp_ntz", "boolean", "short", "byte"):
            size = F.lit(8)
        else:
            size = F.lit(64)
        total = total + size
    return total


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and about ``max_bytes``
    bytes. One aggregation job (partial counts per task, one row each to the
    final step); no limit, which would funnel rows into a single task."""
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return got["n"] <= max_rows and (got["b"] or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only when its size is checked to be small.

    Returns (frame, broadcast?). A frame counted to be above the bound is marked
    for a join that shuffles: Spark's estimate does not see rows that an explode
    adds, so left to itself it may collect such a frame on the driver.
    ``max_rows=None`` skips the check and leaves the choice to Spark.
    """
    if max_rows is None:
        return df, False
    if fits_broadcast(df, max_rows):
        return F.broadcast(df), True
    return df.hint("merge"), False


def null_salt(keys: Sequence[str], salt_from: Sequence[str]) -> Column:
    """Second join column for the left side: 0, or one of ``NULL_KEY_SALTS``
    values for a row with a NULL key (which matches nothing), so that such rows
    spread over partitions. The other side carries 0; keys keep their type."""
    some_null = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_from]), F.lit(NULL_KEY_SALTS)).cast("int")
    return F.when(some_null, salt).otherwise(F.lit(0))


def left_join_flag(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str | None = None,
    flag: str | None = None,
    flag_from: str | None = None,
    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
    salt_from: Sequence[str] | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Left outer join to a lookup plus a 0/1 merge indicator column.

    ``also`` names further key columns that both sides have (such as YEAR);
    the left side's stay.

    * ``right_on`` differs from ``left_on``: both key columns are kept (the
      right key is NULL for unmatched rows) and the flag tests the right key.
    * same name: USING-style join (one key column) and the flag tests
      ``flag_from`` (a right-side value column).

    A lookup of checked, bounded size is broadcast; otherwise the join
    shuffles and rows with a NULL key are salted (by ``salt_from``, all columns
    by default) so they spread over partitions instead of forming one hot
    partition. Both ways give the same rows for keys of any type.
    """
    right_on = right_on or left_on
    right, is_broadcast = bounded_broadcast(right, broadcast_max_rows)
    same_name = right_on == left_on
    if same_name:
        renamed = f"__rk_{right_on}"
        right = right.withColumnRenamed(right_on, renamed)
        rkey = renamed
    else:
        rkey = right_on
    right = right.withColumnsRenamed({c: f"__also_{c}" for c in also})
    same = functools.reduce(lambda a, b: a & b, [left[c] == right[f"__also_{c}"] for c in also], left[left_on] == right[rkey])
    if is_broadcast:
        joined = left.join(right, same, "left")
    else:
        salted = left.withColumn("__salt", null_salt([left_on, *also], salt_from or left.columns))
        right = right.withColumn("__salt_0", F.lit(0))
        same = functools.reduce(
            lambda a, b: a & b,
            [salted[c] == right[f"__also_{c}"] for c in also],
            (salted[left_on] == right[rkey]) & (salted["__salt"] == right["__salt_0"]),
        )
        joined = salted.join(right, same, "left").drop("__salt", "__salt_0")
    joined = joined.drop(*[f"__also_{c}" for c in also])
    if flag:
        test = F.col(rkey) if not same_name else F.col(flag_from or rkey)
        joined = joined.withColumn(flag, merge_flag(test))
    if same_name:
        joined = joined.drop(rkey)
    return joined


def unmatched(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str | None = None,
    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Rows of ``left`` whose key has no partner in ``right`` (NULL keys included).

    When the keys are too many to broadcast, NULL left keys are salted (they
    never match) so they do not pile into one shuffle partition."""
    right_on = right_on or left_on
    keys = right.select(F.col(right_on).alias("__rk")).where(F.col("__rk").isNotNull()).distinct()
    keys, is_broadcast = bounded_broadcast(keys, broadcast_max_rows)
    if is_broadcast:
        return left.join(keys, left[left_on] == keys["__rk"], "left_anti")
    salted = left.withColumn("__salt", null_salt([left_on], left.columns))
    keys = keys.withColumn("__salt_0", F.lit(0))
    same = (salted[left_on] == keys["__rk"]) & (salted["__salt"] == keys["__salt_0"])
    return salted.join(keys, same, "left_anti").drop("__salt")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (partial
    aggregation per task, so a hot key costs one row per task)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def dedupe_latest(df: DataFrame, keys: Sequence[str], latest: str | None = "ingestion_date") -> DataFrame:
    """One row per key: the most recent ``latest`` value wins (NULL dates lose);
    ties are broken by all remaining columns (greatest first) so the result
    does not depend on partitioning.

    Built as ``max(struct(latest, rest...))`` per key: an aggregate with a
    map-side partial step, so a key holding a third of the rows never moves
    as a whole into one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = ([latest] if latest in rest else []) + [c for c in rest if c != latest]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in order]).select(*df.columns)


def assert_unique(df: DataFrame, keys: Sequence[str], on_duplicate: str = "error", latest: str | None = None) -> DataFrame:
    """Guard a lookup or upsert source against repeated keys. Rows with a NULL
    in the key match nothing, so they are never duplicates and pass unchanged.

    ``error``: raise if any key repeats (one aggregation job);
    ``latest``: keep one row per key, the one with the greatest ``latest``
    column, which must exist (:func:`dedupe_latest`);
    ``keep``: pass the frame through unchanged.
    """
    if on_duplicate == "keep":
        return df
    whole = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if on_duplicate == "latest":
        if latest is None or latest not in df.columns:
            raise ValueError(f"on_duplicate='latest' needs the column that says which row is latest, got {latest!r}")
        return dedupe_latest(df.where(whole), keys, latest).unionByName(df.where(~whole))
    if on_duplicate == "error":
        dup = duplicate_keys(df.where(whole), keys).limit(1).collect()
        if dup:
            raise ValueError(f"duplicate key {dict(dup[0].asDict())} for keys {list(keys)}")
        return df
    raise ValueError(f"on_duplicate must be error, latest or keep, not {on_duplicate!r}")
