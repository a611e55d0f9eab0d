import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlake.operators import relate
from tests.conftest import rows


@pytest.fixture
def claims(spark):
    return spark.createDataFrame(
        [("c1", "p1", "n1"), ("c2", "p2", "n2"), ("c3", None, "n1"), ("c4", "p9", None), ("c5", "p1", "n3")],
        "CLAIM_ID string, PATIENT_ID string, NDC string")


@pytest.fixture
def pats(spark):
    return spark.createDataFrame([("p1", 1950), ("p2", None)], "PATIENT_ID_REF string, PATIENT_BRTH_YR int")


@pytest.mark.parametrize("bound", [relate.DEFAULT_BROADCAST_MAX_ROWS, 0])
def test_left_join_flag_keeps_rows_and_flags(spark, claims, pats, bound):
    j = relate.left_join_flag(claims, pats, "PATIENT_ID", "PATIENT_ID_REF", flag="m",
                              broadcast_max_rows=bound, salt_from=["CLAIM_ID"])
    assert j.count() == claims.count()
    assert rows(j, "CLAIM_ID", "PATIENT_ID_REF", "m") == [
        ("c1", "p1", 1), ("c2", "p2", 1), ("c3", None, 0), ("c4", None, 0), ("c5", "p1", 1)]


def test_left_join_flag_using_style(spark, claims):
    flags = spark.createDataFrame([("n1", "B"), ("n2", None)], "NDC string, BENZO_FLAG string")
    j = relate.left_join_flag(claims, flags, "NDC", flag="merged", flag_from="BENZO_FLAG")
    assert j.columns.count("NDC") == 1
    assert rows(j, "CLAIM_ID", "BENZO_FLAG", "merged") == [
        ("c1", "B", 1), ("c2", None, 0), ("c3", "B", 1), ("c4", None, 0), ("c5", None, 0)]


def test_bounded_broadcast_checks_size(spark):
    df = spark.range(10)
    assert relate.bounded_broadcast(df, 10)[1] is True
    assert relate.bounded_broadcast(df, 9)[1] is False
    assert relate.bounded_broadcast(df, None)[1] is False


def test_a_lookup_counted_above_the_bound_is_not_broadcast(spark, claims):
    # Spark's estimate of an exploded frame is that of the frame before
    some = spark.range(2).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("PATIENT_ID_REF"))
    every = some.withColumn("YEAR", F.explode(F.sequence(F.lit(1990), F.lit(2010))))
    joined = relate.left_join_flag(claims.withColumn("YEAR", F.lit(2000)), every, "PATIENT_ID", "PATIENT_ID_REF", flag="m", broadcast_max_rows=20, also=["YEAR"])
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    missing = relate.unmatched(claims, every, "PATIENT_ID", "PATIENT_ID_REF", broadcast_max_rows=0)
    assert "BroadcastHashJoin" not in missing._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bound", [relate.DEFAULT_BROADCAST_MAX_ROWS, 0])
def test_unmatched_includes_null_keys(spark, claims, pats, bound):
    out = relate.unmatched(claims, pats, "PATIENT_ID", "PATIENT_ID_REF", broadcast_max_rows=bound)
    assert sorted(r.CLAIM_ID for r in out.collect()) == ["c3", "c4"]
    assert out.columns == claims.columns


def test_dedupe_latest_is_deterministic(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("k1", "a", d(2020, 1, 1)), ("k1", "b", d(2021, 1, 1)),       # later date wins
        ("k2", "a", d(2020, 1, 1)), ("k2", "b", d(2020, 1, 1)),       # equal dates: greatest rest wins
        ("k3", "x", None), ("k3", "y", d(2019, 1, 1)),                # NULL date loses
        ("k4", "z", d(2020, 1, 1)), ("k4", "z", d(2020, 1, 1)),       # exact copies collapse
        (None, "n", d(2020, 1, 1)), (None, "m", d(2020, 1, 1)),       # NULL key is one group
    ], "k string, v string, ingestion_date date")
    out = relate.dedupe_latest(df, ["k"])
    assert out.columns == df.columns
    assert rows(out, "k", "v") == [(None, "n"), ("k1", "b"), ("k2", "b"), ("k3", "y"), ("k4", "z")]
    shuffled = relate.dedupe_latest(df.repartition(7, F.rand(3)), ["k"])
    assert rows(shuffled) == rows(out)


def test_assert_unique_modes(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    with pytest.raises(ValueError, match="duplicate key"):
        relate.assert_unique(df, ["k"], "error")
    assert relate.assert_unique(df, ["k"], "keep").count() == 3
    assert rows(relate.assert_unique(df, ["k"], "latest", "v")) == [("a", 2), ("b", 3)]
    with pytest.raises(ValueError, match="latest"):
        relate.assert_unique(df, ["k"], "latest")
    nulls = df.unionByName(spark.createDataFrame([(None, 1), (None, 1)], df.schema)).where("k IS NULL OR v > 1")
    assert relate.assert_unique(nulls, ["k"]).count() == 4  # a NULL key repeats nothing
    assert relate.assert_unique(nulls, ["k"], "latest", "v").where("k IS NULL").count() == 2
    assert relate.duplicate_keys(df, ["k"]).first()["count"] == 2


@pytest.mark.parametrize("kind", ["string", "long", "date"])
def test_joins_give_the_same_rows_below_and_above_the_bound(spark, kind):
    key = "date_add(date'2020-01-01', cast({} as int))" if kind == "date" else f"cast({{}} as {kind})"
    left = spark.range(60).selectExpr("id", f"CASE WHEN id % 7 > 0 THEN {key.format('id % 11')} END AS k", "cast(id % 3 as int) AS YEAR")
    right = spark.range(16).selectExpr(f"CASE WHEN id < 15 THEN {key.format('id % 8')} END AS r", "cast(id % 2 as int) AS YEAR", "id AS v")
    for also in ((), ("YEAR",)):
        both = [relate.left_join_flag(left, right.drop(*({"YEAR"} - set(also))), "k", "r", "hit", broadcast_max_rows=n, also=also) for n in (1000, 0)]
        assert both[0].columns == both[1].columns
        assert rows(both[0]) == rows(both[1])
    assert rows(relate.unmatched(left, right, "k", "r")) == rows(relate.unmatched(left, right, "k", "r", broadcast_max_rows=0))
