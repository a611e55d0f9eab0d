"""Mergeable column profiles: partial states per group, merged for any span of them.

``partial`` makes one row per group and column: rows, non-NULL values, mean, sum of
squared distances from it, least and largest value, a distinct-count sketch and a
quantile sketch (Spark's own). ``write`` replaces the states of the years that are
delivered and leaves the others; ``merged`` gives the figures of any grouping of the
stored states without reading the table again. Counts, mean, deviation, least and
largest value are exact but for rounding. ``approx_distinct`` has a relative standard
error of about 1.04 / sqrt(2 ** LG_K) (0.8 %), ``quantile`` a rank error of about 1.65 %
of all values (the sketch's default size).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.session import materialize
from claimlake.sources import io

LG_K = 14


def partial(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("YEAR", "MARKET_NAME")) -> DataFrame:
    """(by..., column, rows, n, mean, m2, min, max, distinct, quantiles) in one aggregation.
    Values are taken as doubles; a column without values in a group has NULL
    figures and empty sketches."""
    def state(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
            F.min(x).alias("min"), F.max(x).alias("max"),
            # -0.0 and 0.0 are one value
            F.hll_sketch_agg(F.when(x.isNotNull(), (x + F.lit(0.0)).cast("string")), F.lit(LG_K)).alias("distinct"),
            F.kll_sketch_agg_double(x).alias("quantiles"))

    found = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.array(*[state(c) for c in columns]).alias("states"))
    return found.select(*by, "rows", F.inline("states"))


def write(df: DataFrame, columns: Sequence[str], base: str, dataset: str, by: Sequence[str] = ("MARKET_NAME",), years: Sequence[int] | None = None) -> str:
    """Stores the states of the years in ``df`` (or ``years``) in place of earlier ones.
    They are stored aside first: the write reads them twice, the table is read once."""
    states = materialize(partial(df, columns, ("YEAR", *by)), "profile-states")
    return io.write_year(states, base, "silver", dataset, years=years)


def merged(states: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(by..., column, rows, n, mean, stddev, min, max, approx_distinct, quantiles) of the groups of ``states``."""
    keys = [*by, "column"]
    # distances from the mean of the whole, so that nothing cancels out
    whole = states.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("whole_mean"))
    same = reduce(lambda a, b: a & b, [F.col(f"s.`{k}`").eqNullSafe(F.col(f"w.`{k}`")) for k in keys])
    joined = states.alias("s").join(whole.alias("w"), same).select("s.*", "w.whole_mean")
    spread = F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("whole_mean"), F.lit(2)))
    out = joined.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.first("whole_mean").alias("mean"), spread.alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("approx_distinct"),
        # states of one column: as many as there are groups (years x markets), not rows
        F.collect_list(F.when(F.col("n") > 0, F.col("quantiles"))).alias("sketches"))
    one = F.reduce(F.slice("sketches", 2, F.greatest(F.size("sketches") - 1, F.lit(0))), F.get("sketches", F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b))
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    return out.select(
        *keys, "rows", "n", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"), "min", "max", "approx_distinct",
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(one, at)).alias("quantiles"))
