"""Numeric summaries: grouped statistics, quantiles, IQR outlier counts.

Quantiles follow the discrete definition (``percentile_disc``): the smallest
value whose cumulative share reaches p. Three methods:

* ``exact`` (default): distributed selection. A first aggregation counts
  the rows of every group. A group with at most ``max_exact_rows`` values is
  ranked with a window straight away. For a larger group, a bounded-size
  quantile sketch (``percentile_approx``) of its candidates narrows the value
  bracket that must hold the wanted rank (to ~3/grid of it per round), and a
  counting pass shifts the rank into the new bracket, until the bracket is
  small enough to rank or holds one repeated value. No task ever holds more
  than a sketch or ``max_exact_rows`` values, whatever the size or skew of a
  group.
* ``disc``: Spark's ``percentile_disc`` aggregate (keeps a count per
  distinct value in one buffer per group: fine for small value domains).
* ``approx``: ``percentile_approx`` with ``accuracy`` (rank error 1/accuracy),
  the behaviour of an ``approxQuantile`` call.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.functions.codes import ratio_pct
from claimlake.operators.relate import DEFAULT_BROADCAST_MAX_ROWS
from claimlake.session import materialize, shared_root

MAX_EXACT_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000
GRID = 256
IQR_FACTOR = 1.5


def _data(df: DataFrame, value: str, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    gcols = list(by) or ["__g"]
    cols = [F.col(b) for b in by] if by else [F.lit(0).alias("__g")]
    data = df.select(*cols, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    return data, gcols


def _targets(probs: Mapping[str, float]) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(name).alias("t"), F.lit(float(p)).alias("p")) for name, p in probs.items()
    ]))


def _join_groups(data: DataFrame, state: DataFrame, gcols: Sequence[str], small: bool) -> DataFrame:
    """Attach each row's per-group state; NULL group values match (null-safe).
    The state has one row per group and target; it is broadcast when its
    counted size is within the broadcast bound (``small``)."""
    st = state.select(*[F.col(g).alias(f"__s_{g}") for g in gcols],
                      *[c for c in state.columns if c not in gcols])
    if small:
        st = F.broadcast(st)
    cond = None
    for g in gcols:
        e = data[g].eqNullSafe(st[f"__s_{g}"])
        cond = e if cond is None else cond & e
    return data.join(st, cond).drop(*[f"__s_{g}" for g in gcols])


def _in_bracket(lo: str, hi: str, lox: str, hix: str) -> Column:
    """lo <= v <= hi, an end is open when NULL and exclusive when its flag is set."""
    v, L, H = F.col("__v"), F.col(lo), F.col(hi)
    lo_ok = L.isNull() | (v > L) | ((v == L) & ~F.col(lox))
    hi_ok = H.isNull() | (v < H) | ((v == H) & ~F.col(hix))
    return lo_ok & hi_ok


def _narrow(state: DataFrame, grid: int, accuracy: int) -> DataFrame:
    """New ends (lo2, hi2) from the sketch of the current candidates so that
    the k-th candidate stays inside: the sketch's rank error is at most
    n/accuracy, so grid points 2*grid/accuracy steps beyond the target
    share bracket it. An end that would fall outside the grid keeps the old
    end (and its exclusivity)."""
    n, k = F.col("__n").cast("double"), F.col("__k").cast("double")
    margin = 2.0 * grid / accuracy
    lo_i = F.floor((k - 1) / n * grid - margin)
    hi_i = F.ceil(k / n * grid + margin)
    keep_lo, keep_hi = lo_i < 0, hi_i > grid
    return state.withColumns({
        "__lo2": F.when(keep_lo, F.col("__lo")).otherwise(F.element_at("__grid", (lo_i + 1).cast("int"))),
        "__lox2": F.when(keep_lo, F.col("__lox")).otherwise(F.lit(False)),
        "__hi2": F.when(keep_hi, F.col("__hi")).otherwise(F.element_at("__grid", (hi_i + 1).cast("int"))),
        "__hix2": F.when(keep_hi, F.col("__hix")).otherwise(F.lit(False)),
    })


MAX_ROUNDS = 200


def _exact(df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str],
           max_exact_rows: int, accuracy: int, grid: int, materialized: bool) -> DataFrame:
    shared_root(df.sparkSession)  # checkpoint() below needs the shared folder
    data, gcols = _data(df, value, by)
    if not materialized:
        data = materialize(data, "quantile-values")  # read twice a round
    pct = [i / grid for i in range(grid + 1)]
    keys = [*gcols, "__t"]
    nul_d, no = F.lit(None).cast("double"), F.lit(False)
    # Pass 1: rows per group; target rank k per (group, target). The bracket
    # [lo, hi] (NULL = open end) starts as everything.
    state = (
        data.groupBy(*gcols).agg(F.count(F.lit(1)).alias("__n"))
        .select(*gcols, "__n", _targets(probs).alias("__tp"))
        .select(*gcols, F.col("__tp.t").alias("__t"), "__n",
                F.greatest(F.ceil(F.col("__tp.p") * F.col("__n")), F.lit(1)).cast("long").alias("__k"),
                nul_d.alias("__lo"), nul_d.alias("__hi"), no.alias("__lox"), no.alias("__hix"),
                no.alias("__done"))
    )
    # Open: too many candidates to rank with a window, value not found yet.
    open_ = (F.col("__n") > max_exact_rows) & ~F.col("__done")
    in_old = _in_bracket("__lo", "__hi", "__lox", "__hix")
    for _ in range(MAX_ROUNDS):
        state = state.checkpoint(eager=True)  # small (groups x targets); cuts the loop's lineage
        size = state.agg(F.count(F.lit(1)).alias("rows"), F.count_if(open_).alias("open"),
                         F.count_if((F.col("__k") < 1) | (F.col("__k") > F.col("__n"))).alias("bad")).first()
        if size["bad"]:
            raise RuntimeError("quantile bracket lost its rank")
        small = size["rows"] <= DEFAULT_BROADCAST_MAX_ROWS
        if size["open"] == 0:
            break
        todo = state.where(open_)
        # Sketch of the current candidates of every open target (bounded size per group).
        sk = (_join_groups(data, todo, gcols, small).where(in_old)
              .groupBy(*keys).agg(F.percentile_approx("__v", pct, accuracy).alias("__grid")))
        # null-safe: rows without a group are a group
        sk = sk.withColumnsRenamed({x: f"__o_{x}" for x in keys})
        met = functools.reduce(lambda a, b: a & b, [todo[x].eqNullSafe(sk[f"__o_{x}"]) for x in keys])
        both = todo.join(sk, met).drop(*[f"__o_{x}" for x in keys])
        bounds = _narrow(both, grid, accuracy).drop("__grid", "__n", "__done")
        # Count below / inside / on each end of the narrower bracket.
        v = F.col("__v")
        inside = _in_bracket("__lo2", "__hi2", "__lox2", "__hix2")
        lo_ok = F.col("__lo2").isNull() | (v > F.col("__lo2")) | ((v == F.col("__lo2")) & ~F.col("__lox2"))
        c = (_join_groups(data, bounds, gcols, small).where(in_old)
             .groupBy(*keys).agg(
                 *[F.first(x).alias(x) for x in ("__k", "__lo2", "__hi2", "__lox2", "__hix2")],
                 F.count_if(~lo_ok).alias("below"),
                 F.count_if(inside).alias("inn"),
                 F.count_if(inside & (v == F.col("__lo2"))).alias("at_lo"),
                 F.count_if(inside & (v == F.col("__hi2"))).alias("at_hi")))
        k1 = F.col("__k") - F.col("below")
        on_lo = F.col("__lo2").isNotNull() & (k1 <= F.col("at_lo"))
        on_hi = F.col("__hi2").isNotNull() & (k1 > F.col("inn") - F.col("at_hi"))
        found = F.when(on_lo, F.col("__lo2")).when(on_hi, F.col("__hi2"))
        # Not on an end: the value lies strictly between the ends, so both
        # tie blocks leave the candidates (every round removes rows).
        nxt = c.select(
            *keys,
            F.when(found.isNotNull(), F.lit(1)).otherwise(F.col("inn") - F.col("at_lo") - F.col("at_hi")).alias("__n"),
            F.when(found.isNotNull(), F.lit(1)).otherwise(k1 - F.col("at_lo")).cast("long").alias("__k"),
            F.coalesce(found, F.col("__lo2")).alias("__lo"),
            F.coalesce(found, F.col("__hi2")).alias("__hi"),
            F.when(found.isNotNull(), no).otherwise(F.col("__lo2").isNotNull() | F.col("__lox2")).alias("__lox"),
            F.when(found.isNotNull(), no).otherwise(F.col("__hi2").isNotNull() | F.col("__hix2")).alias("__hix"),
            found.isNotNull().alias("__done"),
        )
        state = state.where(~open_).unionByName(nxt)
    else:
        raise RuntimeError(f"quantile selection did not finish in {MAX_ROUNDS} rounds")
    bounds = state.select(*keys, "__k", "__n", "__lo", "__hi", "__lox", "__hix", "__done")
    done = bounds.where(F.col("__done")).select(*keys, F.col("__lo").alias("__q"))
    # One ranked pass serves all targets that share a bracket (at first, the whole group).
    ends = ["__lo", "__hi", "__lox", "__hix"]
    few = (bounds.where(~F.col("__done")).groupBy(*gcols, *ends)
           .agg(F.collect_list(F.struct("__t", "__k")).alias("__wanted"), F.min("__t").alias("__bracket")))
    cand = _join_groups(data, few, gcols, small).where(in_old)
    w = Window.partitionBy(*gcols, "__bracket").orderBy("__v")
    hits = F.filter("__wanted", lambda x: x["__k"] == F.col("__rn"))
    ranked = (cand.withColumn("__rn", F.row_number().over(w)).withColumn("__hit", F.explode(hits))
              .select(*gcols, F.col("__hit.__t").alias("__t"), F.col("__v").alias("__q")))
    long = ranked.unionByName(done)
    wide = long.groupBy(*gcols).pivot("__t", list(probs)).agg(F.first("__q"))
    return wide.drop("__g") if not by else wide


def quantiles(df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (),
              method: str = "exact", max_exact_rows: int = MAX_EXACT_ROWS,
              accuracy: int = SKETCH_ACCURACY, grid: int = GRID, materialized: bool = False) -> DataFrame:
    """Discrete quantiles of ``value`` (NULLs ignored) per ``by`` group, one
    double column per ``probs`` entry. Without ``by`` the result has one row
    (none when every value is NULL). The exact method reads its groups and values
    several times: they are written once to the shared folder unless ``df`` is a
    cheap read of a stored table (``materialized``)."""
    by = list(by)
    if method == "exact":
        return _exact(df, value, probs, by, max_exact_rows, accuracy, grid, materialized)
    v = F.col(value)
    if method == "disc":
        aggs = [F.expr(f"percentile_disc({float(p)}) within group (order by `{value}`)").cast("double").alias(n)
                for n, p in probs.items()]
    elif method == "approx":
        aggs = [F.percentile_approx(v, float(p), accuracy).cast("double").alias(n) for n, p in probs.items()]
    else:
        raise ValueError(f"method must be exact, disc or approx, not {method!r}")
    src = df.where(v.isNotNull())
    return src.groupBy(*by).agg(*aggs) if by else src.agg(*aggs)


def iqr_fences(df: DataFrame, value: str, method: str = "exact", factor: float = IQR_FACTOR, **kw) -> DataFrame:
    """One row: q1, median, q3 of the whole column and the outlier fences
    q1 - factor*IQR, q3 + factor*IQR (empty when the column is all NULL).
    The row is checkpointed, so using it in several expressions does not
    recompute the quantiles."""
    q = quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, method=method, **kw)
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "median", "q3",
                    (F.col("q1") - factor * iqr).alias("lower"),
                    (F.col("q3") + factor * iqr).alias("upper")).checkpoint(eager=True)


def _narrowed(df: DataFrame, cols: Sequence[str], materialized: bool) -> DataFrame:
    """Only the columns the passes need, written once to the shared folder
    unless the input is already a stored table (``materialized=True``)."""
    out = df.select(*cols)
    return out if materialized else materialize(out, "stats")


def _is_outlier(value: str, fences: DataFrame) -> Column:
    # Scalar subqueries: the one-row fence frame is computed once and its
    # values are used as constants (no join with the data).
    lower = fences.select("lower").scalar()
    upper = fences.select("upper").scalar()
    v = F.col(value)
    return (v < lower) | (v > upper)


def summary_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """mean, sample stddev, min, max and non-NULL count per group, by group."""
    v = F.col(value)
    return (df.groupBy(group)
            .agg(F.avg(v).alias("mean"), F.stddev(v).alias("stddev"), F.min(v).alias("min"),
                 F.max(v).alias("max"), F.count(v).alias("count"))
            .orderBy(F.asc_nulls_first(group)))


def count_outliers(df: DataFrame, value: str, group: str, method: str = "exact",
                   materialized: bool = False, **kw) -> DataFrame:
    """Per group, values outside the *global* 1.5 x IQR fences; groups without
    outliers are absent."""
    df = _narrowed(df, [group, value], materialized)
    fences = iqr_fences(df, value, method=method, materialized=True, **kw)
    return (df.where(_is_outlier(value, fences)).groupBy(group)
            .agg(F.count(F.lit(1)).alias("outlier_count")))


def robust_summary(df: DataFrame, value: str, group: str, method: str = "exact",
                   materialized: bool = False, **kw) -> DataFrame:
    """Per group: total_observations (non-NULL), min, median, mean and stddev
    (2 dp), max, count_outliers against the global fences and their share in
    percent (2 dp). The median is per group; the fences are global.

    The (group, value) columns are written once (``materialized=True`` when
    ``df`` is already a stored table) and every pass reads them."""
    df = _narrowed(df, [group, value], materialized)
    v = F.col(value)
    fences = iqr_fences(df, value, method=method, materialized=True, **kw)
    stats = df.groupBy(group).agg(
        F.count(v).alias("total_observations"),
        F.min(v).alias("min"),
        F.round(F.avg(v), 2).alias("mean"),
        F.round(F.stddev(v), 2).alias("stddev"),
        F.max(v).alias("max"),
        F.count_if(_is_outlier(value, fences)).alias("count_outliers"),
    )
    med = quantiles(df, value, {"median": 0.5}, by=[group], method=method, materialized=True, **kw).withColumnRenamed(group, "__grp")
    out = stats.join(med, stats[group].eqNullSafe(med["__grp"]), "left").drop("__grp")
    return out.select(
        group, "total_observations", "min", "median", "mean", "stddev", "max", "count_outliers",
        ratio_pct("count_outliers", "total_observations").alias("percentage_outliers"),
    )


def robust_summaries(df: DataFrame, values: Sequence[str], group: str, method: str = "exact",
                     materialized: bool = False, **kw) -> DataFrame:
    """:func:`robust_summary` of several measures at once, one row per
    ``measure`` and group (min and max as doubles), stored in the shared folder.

    The measures, and the global and group quantiles of each, are groups of
    one unpivoted frame, so counting, narrowing and ranking are shared: the number of
    passes doesn't grow with measures or targets."""
    values = list(values)
    df = _narrowed(df, [group, *values], materialized)
    cell = lambda v, whole: F.struct(F.lit(v).alias("measure"), F.lit(whole).alias("whole"), F.col(v).cast("double").alias("v"))
    long = df.select(group, F.explode(F.array(*[cell(v, whole) for v in values for whole in (True, False)])).alias("c"))
    long = long.select("c.measure", "c.whole", F.when(~F.col("c.whole"), F.col(group)).alias(group), F.col("c.v").alias("v"))
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    # a row per measure and group
    found = materialize(quantiles(long, "v", probs, by=["measure", "whole", group], method=method, materialized=True, **kw), "quantiles")
    fences = {r["measure"]: r for r in found.where("whole").collect()}  # a row per measure
    aggs = []
    for v in values:
        c = F.col(v).cast("double")
        f = fences.get(v)
        spread = None if f is None else IQR_FACTOR * (f["q3"] - f["q1"])
        outside = F.lit(False) if f is None else (c < f["q1"] - spread) | (c > f["q3"] + spread)
        aggs.append(F.struct(
            F.lit(v).alias("measure"), F.count(c).alias("total_observations"), F.min(c).alias("min"), F.round(F.avg(c), 2).alias("mean"),
            F.round(F.stddev(c), 2).alias("stddev"), F.max(c).alias("max"), F.count_if(outside).alias("count_outliers")))
    each = df.groupBy(group).agg(F.array(*aggs).alias("a")).select(group, F.inline("a"))
    med = found.where(~F.col("whole")).select(F.col("measure").alias("__m"), F.col(group).alias("__g"), "median")
    out = each.join(med, (each["measure"] == med["__m"]) & each[group].eqNullSafe(med["__g"]), "left")
    return materialize(out.select(
        "measure", group, "total_observations", "min", "median", "mean", "stddev", "max", "count_outliers",
        ratio_pct("count_outliers", "total_observations").alias("percentage_outliers"),
    ), "summaries")
