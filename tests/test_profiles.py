"""Stored profile states against exact figures."""

import math

import pytest
from pyspark.sql import functions as F

from claimlake.operators import profiles
from claimlake.session import shared_path
from claimlake.sources import claims_view as cv
from claimlake.sources import io
from tests.conftest import SF_SMALL


def test_merged_states_equal_the_table(spark):
    c = cv.claims(spark, SF_SMALL)
    states = profiles.partial(c, ["PATIENT_PAY", "QUANTITY"]).persist()
    for by in ((), ("YEAR",), ("MARKET_NAME",)):
        got = {tuple(r[k] for k in by): r for r in profiles.merged(states, by).where("column = 'PATIENT_PAY'").collect()}
        x = F.col("PATIENT_PAY")
        want = c.groupBy(*by).agg(F.count("*").alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev(x).alias("stddev"), F.min(x).alias("min"), F.max(x).alias("max"),
                                  F.count_distinct(x).alias("d"), F.sort_array(F.collect_list(x)).alias("all")).collect()
        assert len(got) == len(want)
        for w in want:
            g = got[tuple(w[k] for k in by)]
            assert (g.rows, g.n, g.min, g.max) == (w.rows, w.n, w.min, w.max)
            assert math.isclose(g.mean, w["mean"], rel_tol=1e-9) and math.isclose(g.stddev, w.stddev, rel_tol=1e-9)
            assert abs(g.approx_distinct - w.d) <= max(2, 0.03 * w.d)
            for q, value in zip((0.25, 0.5, 0.75), g.quantiles, strict=True):
                below = sum(1 for v in w["all"] if v < value) / w.n
                upto = sum(1 for v in w["all"] if v <= value) / w.n
                assert below - 0.05 <= q <= upto + 0.05


def test_edges(spark):
    df = spark.createDataFrame([(1, "a", None, 5), (1, "a", None, 5), (2, None, 1e9 + 1, 1), (2, None, 1e9 + 2, 2), (2, "b", 1e9 + 3, None)], "YEAR int, MARKET_NAME string, x double, `y z` int")
    got = {r.column: r for r in profiles.merged(profiles.partial(df, ["x", "y z"])).collect()}
    assert (got["x"].rows, got["x"].n, got["x"].stddev, got["x"].approx_distinct) == (5, 3, 1.0, 3)
    assert (got["y z"].n, got["y z"].min, got["y z"].max, got["y z"].approx_distinct) == (4, 1.0, 5.0, 3)
    none = profiles.merged(profiles.partial(df.where("YEAR = 1"), ["x"])).collect()[0]
    assert (none.rows, none.n, none["mean"], none.stddev, none.approx_distinct, none.quantiles) == (2, 0, None, None, 0, None)
    assert profiles.merged(profiles.partial(df.where("false"), ["x"])).count() == 0
    groups = profiles.merged(profiles.partial(df, ["x"]), ("MARKET_NAME",)).collect()
    assert {r.MARKET_NAME: r.rows for r in groups} == {"a": 2, None: 2, "b": 1}


def test_a_year_again_leaves_the_others(spark):
    base = shared_path(spark, "t-profiles")
    df = spark.createDataFrame([(y, m, float(y + i)) for y in (2020, 2021) for m in "ab" for i in range(5)], "YEAR int, MARKET_NAME string, x double")
    profiles.write(df, ["x"], base, "profiles")
    path = io.layer_path(base, "silver", "profiles")
    before = sorted(spark.read.parquet(f"{path}/YEAR=2020").inputFiles())
    profiles.write(df.where("YEAR = 2021 and MARKET_NAME = 'a'").withColumn("x", F.lit(1.0)), ["x"], base, "profiles")
    stored = spark.read.parquet(path)
    assert sorted(spark.read.parquet(f"{path}/YEAR=2020").inputFiles()) == before
    got = {r.YEAR: (r.n, r["mean"]) for r in profiles.merged(stored, ("YEAR",)).collect()}
    assert got == {2020: (10, 2022.0), 2021: (5, pytest.approx(1.0))}


def test_the_table_is_read_once_to_store_its_states(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(x):
        seen.add(1)
        return float(x)

    df = spark.range(40).select(F.lit(2000).alias("YEAR"), F.lit("A").alias("MARKET_NAME"), value("id").alias("x"))
    profiles.write(df.withColumn("MARKET_NAME", F.when(F.col("x") > 9, "A").otherwise("B")), ["x"], shared_path(spark, "t-profile-once"), "profiles")
    assert seen.value == 40
