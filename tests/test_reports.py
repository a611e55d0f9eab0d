"""Shared summaries, domains, rejects, checks and the gate before a write."""

import random

import pytest
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.operators import clean, quality, stats
from claimlake.plans import jobs
from claimlake.plans import queries as q
from claimlake.session import shared_path
from claimlake.sources import claims_view as cv
from claimlake.sources import io
from tests.conftest import SF_SMALL, rows


def _values(spark):
    r = random.Random(2)
    data = [(r.choice(["a", "b", None]), r.choice([None, float(r.randint(0, 40))]), r.randint(-5, 5), None) for _ in range(400)]
    data += [("hot", 1.0, 1, None)] * 500 + [("far", 1e6, 900, None)]
    return spark.createDataFrame(data, "g string, x double, y int, z double")


@pytest.mark.parametrize("most", [1_000_000, 20])
def test_shared_summaries_equal_single_ones(spark, most):
    df = _values(spark)
    got = stats.robust_summaries(df, ["x", "y"], "g", max_exact_rows=most, accuracy=100, grid=10)
    for v in ("x", "y"):
        one = stats.robust_summary(df.withColumn(v, F.col(v).cast("double")), v, "g", max_exact_rows=most, accuracy=100, grid=10)
        assert rows(got.where(F.col("measure") == v).drop("measure"), *one.columns) == rows(one)
        disc = {r.g: r.m for r in stats.quantiles(df, v, {"m": 0.5}, by=["g"], method="disc").collect()}
        assert {r.g: r.median for r in one.collect()} == disc  # the rows without a group too


def test_shared_summaries_take_few_jobs_and_survive_empty_columns(spark):
    df = _values(spark).repartition(2).cache()
    df.count()
    spark.sparkContext.setJobGroup("summaries", "summaries")
    got = stats.robust_summaries(df, ["x", "y", "z"], "g", materialized=True)
    spark.sparkContext.setJobGroup("", "")
    taken = len(spark.sparkContext.statusTracker().getJobIdsForGroup("summaries"))
    assert taken <= 16, taken
    assert got.count() == 15
    assert {r.total_observations for r in got.where("measure = 'z'").collect()} == {0}
    assert stats.robust_summaries(df.limit(0), ["x"], "g").count() == 0
    df.unpersist()


def test_frequencies_and_domains(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), ("s0", 2)], "v string, n int")
    got = rows(quality.frequencies(df, {"v": F.col("v"), "n": F.col("n"), "no": F.col("n").isNull()}))
    assert got == sorted([("n", None, 1), ("n", "1", 2), ("n", "2", 1), ("no", "false", 3), ("no", "true", 1), ("v", None, 1), ("v", "a", 2), ("v", "s0", 1)],
                         key=lambda t: tuple((x is not None, x) for x in t))
    dom = {(r.column_name, r.value): r.is_valid for r in quality.value_domains(df, {"v": ["a"], "n": ["2"]}).collect()}
    assert dom == {("v", "a"): True, ("v", "s0"): False, ("v", None): False, ("n", "1"): False, ("n", "2"): True, ("n", None): False}
    assert quality.frequencies(df.limit(0), {"v": F.col("v")}).count() == 0


def test_rejected_cells(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("b", "1x", "2"), (None, "", None)], "k string, i string, j string")
    got = rows(clean.rejected_cells(df, {"i": "int", "j": "int", "absent": "int"}, ["k"], "t"))
    assert got == [("t", None, "i", ""), ("t", "a", "j", "x"), ("t", "b", "i", "1x")]


def test_checks_and_gate(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "n int")
    found = quality.checks(df, {"null": ("warning", F.col("n").isNull(), 0), "large": ("error", F.col("n") > 2, 1), "any": ("error", F.col("n") > 0, 1)})
    assert [tuple(r) for r in found.collect()] == [("null", "warning", 1, "failed"), ("large", "error", 1, "ok"), ("any", "error", 2, "failed")]
    quality.gate(found, strict=False)
    quality.gate(found.where("name <> 'any'"), strict=True)
    with pytest.raises(ValueError, match="any \\(2 rows\\)"):
        quality.gate(found, strict=True)


def test_a_strict_run_that_fails_leaves_the_table_untouched(spark):
    base = shared_path(spark, "t-strict")
    look = (q._patients(spark, SF_SMALL), q._products(spark, SF_SMALL))
    text = clean.cast_types(cv.claims_text(spark, SF_SMALL), {"YEAR": "int", "ingestion_date": "date"}).where("YEAR >= 1997")
    fine = text.where("CLAIM_ID IS NOT NULL AND DAYS_SUPPLY NOT IN ('10', '20', '30', '40')")
    kw = {"base": base, "on_duplicate": "keep"}
    jobs.claims_job(spark, fine, *look, jobs.RunParams(strict=True, **kw))
    before = rows(io.read_layer(spark, base, "silver", "claims"), "CLAIM_ID", "YEAR")
    with pytest.raises(ValueError, match="malformed_value"):
        jobs.claims_job(spark, text, *look, jobs.RunParams(strict=True, **kw))
    assert rows(io.read_layer(spark, base, "silver", "claims"), "CLAIM_ID", "YEAR") == before
    out = jobs.claims_job(spark, text, *look, jobs.RunParams(**kw))
    kept = io.read_layer(spark, base, "quarantine", "claims_rejected")
    assert kept.count() == clean.rejected_cells(text, {"DISPENSE_DATE": "date", "QUANTITY": "double", "PATIENT_PAY": "double", "DAYS_SINCE_LAST_OPIOID": "int"}, ["CLAIM_ID"], "claims").count() > 0
    assert {r.column_name for r in out["value_domains"].collect()} == set(schemas.VALUE_DOMAINS)
    # delivered again without malformed values: the year's rejects go
    jobs.claims_job(spark, fine, *look, jobs.RunParams(**kw))
    assert io.read_layer(spark, base, "quarantine", "claims_rejected", schema=kept.schema).count() == 0
