"""Joins of tables stored by the same buckets: same rows as the plain join, nothing moves."""

import re

import pytest
from pyspark.sql import functions as F

from claimlake.operators import colocate, relate
from claimlake.plans import jobs
from claimlake.plans import queries as q
from claimlake.session import shared_path
from claimlake.sources import claims_view as cv
from claimlake.sources import io
from tests.conftest import SF_SMALL, rows


def _claims(spark):
    """1,200 claims of 100 patients; one patient holds a third, a tenth have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 != 1, F.col("id") % 100).cast("string")
    return spark.range(1200).select(F.col("id").alias("CLAIM_ID"), key.alias("PATIENT_ID"), (F.col("id") % 2 + 2000).cast("int").alias("YEAR"))


def _patients(spark):
    return spark.range(0, 90).select(F.col("id").cast("string").alias("PATIENT_ID_REF"), (F.col("id") + 1900).alias("BORN"))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_same_rows_as_the_plain_join_and_no_exchange(spark, no_broadcast):
    base = shared_path(spark, "t-colocate")
    c = colocate.store(_claims(spark), f"{base}/c", ["PATIENT_ID"], 8)
    p = colocate.store(_patients(spark), f"{base}/p", ["PATIENT_ID_REF"], 8, lookup=True)
    assert "7" in [r[0] for r in c.hot.collect()]
    assert c.apart.where("PATIENT_ID IS NULL").count() == _claims(spark).where("PATIENT_ID IS NULL").count() > 0
    assert rows(c.rows()) == rows(_claims(spark))
    joined = colocate.left_join(c, p, "m")
    want = relate.left_join_flag(_claims(spark), _patients(spark), "PATIENT_ID", "PATIENT_ID_REF", flag="m")
    assert rows(joined, *want.columns) == rows(want)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan, plan
    assert len(re.findall("Bucketed: true", plan)) >= 2, plan


def test_year_in_the_key_and_a_new_session_entry(spark, no_broadcast):
    base = shared_path(spark, "t-colocate-year")
    years = spark.createDataFrame([(2000,), (2001,)], "YEAR int")
    ref = _patients(spark).crossJoin(years).withColumn("BORN", F.col("BORN") + F.col("YEAR"))
    colocate.store(_claims(spark), f"{base}/c", ["PATIENT_ID", "YEAR"], 4)
    colocate.store(ref, f"{base}/p", ["PATIENT_ID_REF", "YEAR"], 4, lookup=True)
    for part in ("c", "p"):  # as in a session that has not stored them
        spark.sql(f"DROP TABLE {colocate._name(f'{base}/{part}')}")
    c, p = colocate.read(spark, f"{base}/c"), colocate.read(spark, f"{base}/p")
    joined = colocate.left_join(c, p, "m", broadcast_max_rows=0)
    want = relate.left_join_flag(_claims(spark), ref, "PATIENT_ID", "PATIENT_ID_REF", flag="m", also=["YEAR"])
    assert rows(joined, *want.columns) == rows(want)
    near = colocate.left_join(c, p, "m")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in near, near


def test_filters_keep_the_buckets_and_storing_again_replaces(spark, no_broadcast):
    base = shared_path(spark, "t-colocate-again")
    c = colocate.store(_claims(spark), f"{base}/c", ["PATIENT_ID"], 4)
    assert rows(c.where(F.col("YEAR") == 2000).rows()) == rows(_claims(spark).where("YEAR = 2000"))
    c = colocate.store(_claims(spark).where("CLAIM_ID < 50"), f"{base}/c", ["PATIENT_ID"], 2)
    assert c.buckets == 2 and rows(c.rows()) == rows(_claims(spark).where("CLAIM_ID < 50"))


def test_empty_tables(spark):
    base = shared_path(spark, "t-colocate-empty")
    none = colocate.store(_claims(spark).limit(0), f"{base}/c", ["PATIENT_ID"], 4)
    p = colocate.store(_patients(spark), f"{base}/p", ["PATIENT_ID_REF"], 4, lookup=True)
    assert colocate.left_join(none, p, "m").count() == 0
    c = colocate.store(_claims(spark), f"{base}/c2", ["PATIENT_ID"], 4)
    nobody = colocate.store(_patients(spark).limit(0), f"{base}/p2", ["PATIENT_ID_REF"], 4, lookup=True)
    out = colocate.left_join(c, nobody, "m")
    assert out.count() == 1200 and out.where("m = 1 OR BORN IS NOT NULL").count() == 0


def test_what_cannot_meet_is_an_error(spark):
    base = shared_path(spark, "t-colocate-error")
    c = colocate.store(_claims(spark), f"{base}/c", ["PATIENT_ID"], 4)
    with pytest.raises(ValueError, match="buckets"):
        colocate.left_join(c, colocate.store(_patients(spark), f"{base}/p", ["PATIENT_ID_REF"], 2, lookup=True), "m")
    numbers = _patients(spark).withColumn("PATIENT_ID_REF", F.col("PATIENT_ID_REF").cast("long"))
    with pytest.raises(ValueError, match="other types"):
        colocate.left_join(c, colocate.store(numbers, f"{base}/n", ["PATIENT_ID_REF"], 4, lookup=True), "m")
    with pytest.raises(ValueError, match="both sides"):
        colocate.left_join(c, colocate.store(_patients(spark).withColumn("CLAIM_ID", F.lit(1)), f"{base}/x", ["PATIENT_ID_REF"], 4, lookup=True), "m")
    with pytest.raises(ValueError, match="no table by buckets"):
        colocate.read(spark, f"{base}/nothing")


def test_claims_job_over_colocated_tables_equals_the_plain_one(spark):
    products = q._products(spark, SF_SMALL)
    bronze, patients = cv.claims_bronze(spark, SF_SMALL), q._patients(spark, SF_SMALL)
    plain, stored = (jobs.RunParams(base=shared_path(spark, "t-claims"), on_duplicate="keep") for _ in range(2))
    a = jobs.claims_job(spark, bronze, patients, products, plain)
    b = jobs.claims_job(spark, *jobs.colocate_job(spark, bronze, patients, stored, 4), products, stored)
    silver = io.read_layer(spark, plain.base, "silver", "claims")
    assert rows(silver) == rows(io.read_layer(spark, stored.base, "silver", "claims"), *silver.columns)
    for name in ("unmatched_patients", "unmatched_products", "report"):
        assert rows(a[name]) == rows(b[name])
    # claims that silver drops are in the extracts too
    want = relate.unmatched(bronze, patients, "PATIENT_ID", "PATIENT_ID_REF")
    assert rows(a["unmatched_patients"]) == rows(want, "PATIENT_ID", "CLAIM_ID", "YEAR")
    kept = silver.where("merged_pat_ref = 0").count()
    assert 0 < kept < want.count()


def test_a_large_table_gets_more_buckets(spark, monkeypatch):
    monkeypatch.setattr(colocate, "ROWS_PER_BUCKET", 100)
    p = jobs.RunParams(base=shared_path(spark, "t-colocate-large"))
    c, lookup = jobs.colocate_job(spark, _claims(spark), _patients(spark).withColumn("ingestion_date", F.lit(None).cast("date")), p, 2)
    keyed = _claims(spark).where("PATIENT_ID IS NOT NULL").count()
    assert c.buckets == lookup.buckets == -(-keyed // 100) > 2
    assert rows(c.rows()) == rows(_claims(spark))
    want = relate.left_join_flag(_claims(spark), _patients(spark), "PATIENT_ID", "PATIENT_ID_REF", flag="m")
    assert rows(colocate.left_join(c, lookup, "m"), *want.columns) == rows(want)
