"""Data-quality reports. Each returns a (small) DataFrame instead of printing,
and each is a single aggregation over the input, so a report never needs a
second pass or a driver-side loop over data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.codes import invalid_length


def schema_check(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Every expected and every present column with both types, its status
    (ok, missing, extra, retyped), the rows of the table and the non-NULL values
    of the column, all counted in one aggregation."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*expected, *(c for c in actual if c not in expected)]

    def item(c: str) -> Column:
        want, have = expected.get(c), actual.get(c)
        status = "missing" if have is None else "extra" if want is None else "ok" if want == have else "retyped"
        n = F.count(F.col(f"`{c}`")) if have is not None else F.lit(0).cast("long")
        text = lambda x: F.lit(x).cast("string")
        return F.struct(F.lit(c).alias("column"), text(want).alias("expected_type"), text(have).alias("actual_type"),
                        F.lit(status).alias("status"), n.alias("filled"))

    one = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*[item(c) for c in names]).alias("items"))
    return one.select("rows", F.inline("items"))


def schema_diff(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """The rows of :func:`schema_check` that differ from what is expected."""
    return schema_check(df, expected).where(F.col("status") != "ok")


def row_count_check(df: DataFrame, manifest: DataFrame, data_type: str) -> DataFrame:
    """Actual rows + 1 (the manifest counts the header line) vs the manifest's
    RECORD_COUNT for ``data_type``; one row with a status.

    Both sides are folded into one aggregation over a union (no join):
    ``no_expected`` when the manifest has no such row, ``ambiguous`` when it
    has several (the smallest count is shown).
    """
    m = manifest.where(F.col("DATA_TYPE") == data_type).select(
        F.col("RECORD_COUNT").cast("int").alias("e"), F.lit(1).alias("m"), F.lit(0).alias("a"))
    a = df.select(F.lit(None).cast("int").alias("e"), F.lit(0).alias("m"), F.lit(1).alias("a"))
    agg = m.unionByName(a).agg(
        F.min("e").alias("EXPECTED_COUNT"),
        F.sum("m").cast("long").alias("manifest_rows"),
        (F.sum("a") + 1).cast("long").alias("ACTUAL_COUNT"),
    )
    status = (
        F.when(F.col("manifest_rows") == 0, "no_expected")
        .when(F.col("manifest_rows") > 1, "ambiguous")
        .when(F.col("EXPECTED_COUNT") == F.col("ACTUAL_COUNT"), "match")
        .otherwise("mismatch")
    )
    return agg.select(
        F.lit(data_type).alias("DATA_TYPE"),
        F.col("EXPECTED_COUNT").cast("long").alias("EXPECTED_COUNT"),
        "ACTUAL_COUNT",
        status.alias("STATUS"),
    )


def reconcile_months(claims: DataFrame, manifest: DataFrame, how: str = "full", data_type: str = "factrx") -> DataFrame:
    """Per MONTH_ID: actual rows, expected rows (manifest count - 1 header
    line) and the difference. ``how="full"`` also shows months present on one
    side only (status only_actual / only_expected); ``inner`` shows matches only.
    """
    actual = claims.groupBy(F.col("MONTH_ID").cast("string").alias("MONTH_ID")).agg(
        F.count(F.lit(1)).alias("ACTUAL_COUNT"))
    expected = manifest.where(F.col("DATA_TYPE") == data_type).select(
        F.col("MONTH_ID").cast("string").alias("MONTH_ID"),
        (F.col("RECORD_COUNT").cast("long") - 1).alias("EXPECTED_COUNT"),
    )
    j = actual.join(expected, "MONTH_ID", how)
    status = (
        F.when(F.col("EXPECTED_COUNT").isNull() & F.col("ACTUAL_COUNT").isNotNull(), "only_actual")
        .when(F.col("ACTUAL_COUNT").isNull(), "only_expected")
        .when(F.col("ACTUAL_COUNT") == F.col("EXPECTED_COUNT"), "match")
        .otherwise("mismatch")
    )
    return j.select(
        "MONTH_ID", "ACTUAL_COUNT", "EXPECTED_COUNT",
        (F.col("ACTUAL_COUNT") - F.col("EXPECTED_COUNT")).alias("DIFF"),
        status.alias("STATUS"),
    )


def pivot_counts(df: DataFrame, rows: Sequence[str], pivot: str, values: Sequence[str]) -> DataFrame:
    """Row counts per ``rows`` with one column per ``pivot`` value.

    The value list is explicit: no extra job to find it and a stable schema.
    Rows with a value outside the list are counted in ``OTHER``, rows without
    one in ``NULL_VALUE``, so the columns add up to all rows. Cells without
    rows are NULL (as in a pivoted count).
    """
    c = F.col(pivot)
    known = F.when(c.isNull(), "NULL_VALUE").when(c.isin(list(values)), c.cast("string")).otherwise("OTHER")
    return df.withColumn("__pivot", known).groupBy(*rows).pivot("__pivot", [*map(str, values), "OTHER", "NULL_VALUE"]).count()


def missing_counts(df: DataFrame, long: bool = False) -> DataFrame:
    """NULL count of every column in one aggregation; ``long=True`` unpivots to
    (column, missing) rows."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    if not long:
        return wide
    return wide.unpivot([], list(df.columns), "column", "missing")


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """rows, distinct non-NULL keys, NULL keys and distinct keys counting NULL
    as a value (what ``select(key).distinct().count()`` reports)."""
    k = F.col(key)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(k).alias("distinct_keys"),
        F.count_if(k.isNull()).alias("null_keys"),
    ).withColumn(
        "distinct_with_null",
        F.col("distinct_keys") + F.when(F.col("null_keys") > 0, F.lit(1)).otherwise(F.lit(0)),
    )


def frequency(df: DataFrame, *keys: str, order: str = "key") -> DataFrame:
    """``groupBy(keys).count()``, ordered by key or by count (descending, key
    as tie-break)."""
    out = df.groupBy(*keys).count()
    if order == "count_desc":
        return out.orderBy(F.desc("count"), *[F.asc_nulls_first(k) for k in keys])
    if order == "key":
        return out.orderBy(*[F.asc_nulls_first(k) for k in keys])
    return out


def valid_values(df: DataFrame, c: str, allowed: Iterable | None = None) -> DataFrame:
    """Distinct values of a column with counts; ``is_valid`` says whether the
    value is in ``allowed`` (NULL never is)."""
    out = df.groupBy(c).count()
    if allowed is not None:
        out = out.withColumn("is_valid", F.coalesce(F.col(c).isin(list(allowed)), F.lit(False)))
    return out


def frequencies(df: DataFrame, sections: Mapping[str, Column]) -> DataFrame:
    """(section, value, count) of several expressions from one aggregation (a
    grouping set for each): every value that occurs, as text, NULL too."""
    names = list(sections)
    text = df.select(*[e.cast("string").alias(f"s{i}") for i, e in enumerate(sections.values())])
    columns = text.columns
    sets = text.groupingSets([[c] for c in columns], *columns).agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("g"))
    section, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(columns):
        # the bits of the columns that are not in the set are 1, the first column's is the highest
        here = F.col("g") == ((1 << len(columns)) - 1) ^ (1 << (len(columns) - 1 - i))
        section, value = F.when(here, F.lit(names[i])).otherwise(section), F.when(here, F.col(c)).otherwise(value)
    return sets.select(section.alias("section"), value.alias("value"), "count")


def value_domains(df: DataFrame, domains: Mapping[str, Iterable[str]]) -> DataFrame:
    """(column_name, value, count, is_valid) of several columns in one pass, and
    whether each value is among the column's declared ones (NULL never is)."""
    found = frequencies(df, {c: F.col(c) for c in domains})
    valid = F.lit(False)
    for c, allowed in domains.items():
        valid = F.when(F.col("section") == c, F.coalesce(F.col("value").isin(list(allowed)), F.lit(False))).otherwise(valid)
    return found.select(F.col("section").alias("column_name"), "value", "count", valid.alias("is_valid"))


def checks(df: DataFrame, rules: Mapping[str, tuple[str, Column, int]]) -> DataFrame:
    """(name, severity, value, verdict) of ``{name: (severity, predicate, most)}``: the
    rows that meet the predicate, counted for all rules in one pass, and ``ok`` if
    they are at most ``most``, else ``failed``."""
    counted = df.agg(*[F.count_if(p).alias(n) for n, (_, p, _) in rules.items()])
    each = [
        F.struct(F.lit(n).alias("name"), F.lit(severity).alias("severity"), F.col(n).alias("value"), F.when(F.col(n) <= most, F.lit("ok")).otherwise(F.lit("failed")).alias("verdict"))
        for n, (severity, _, most) in rules.items()
    ]
    return counted.select(F.inline(F.array(*each)))


def gate(found: DataFrame, strict: bool) -> None:
    """Raises in a strict run if a check of severity ``error`` has failed."""
    if strict:
        failed = found.where("severity = 'error' AND verdict = 'failed'").collect()  # a row per rule at most
        if failed:
            raise ValueError("checks failed: " + ", ".join(f"{r['name']} ({r['value']} rows)" for r in failed))


def length_violations(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """One row: per column, values whose length is not the expected width
    (NULL values are not counted)."""
    return df.agg(*[F.count_if(invalid_length(c, w)).alias(c) for c, w in widths.items()])


def profile(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Many row counts in one pass: ``{name: predicate}`` -> one row with a
    ``count_if`` per predicate plus ``rows``."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(p).alias(n) for n, p in checks.items()])


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows in a fixed order (a repeatable look at a table;
    the limit is the point of it). Spark plans it as a top-n: each task keeps
    ``n`` rows, so nothing large moves."""
    cols = list(order_by) or list(df.columns)
    return df.orderBy(*[F.asc_nulls_first(c) for c in cols]).limit(n)
