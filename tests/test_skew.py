"""One key (or NULL) holding a third of the rows: results stay whole and exact."""

from pyspark.sql import functions as F

from claimlake.operators import relate
from claimlake.operators.upsert import upsert
from claimlake.session import shared_path


def _skewed_claims(spark, n=9000):
    return spark.range(n).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("CLAIM_ID"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("PATIENT_ID"),
        (F.lit(2020) + F.col("id") % 2).cast("int").alias("YEAR"),
    )


def test_shuffle_join_with_hot_and_null_keys(spark):
    claims = _skewed_claims(spark)
    pats = spark.createDataFrame([("HOT", 1), ("p2", 2)], "PATIENT_ID_REF string, X int")
    j = relate.left_join_flag(claims, pats, "PATIENT_ID", "PATIENT_ID_REF", flag="m",
                              broadcast_max_rows=0, salt_from=["CLAIM_ID"])
    got = {r.PATIENT_ID: (r.n, r.m) for r in j.groupBy("PATIENT_ID").agg(
        F.count(F.lit(1)).alias("n"), F.max("m").alias("m")).collect()}
    assert j.count() == 9000
    assert got["HOT"] == (3000, 1) and got[None] == (3000, 0) and got["p2"][1] == 1


def test_dedupe_with_hot_key_keeps_one_row(spark):
    claims = _skewed_claims(spark).withColumn("ingestion_date", F.date_add(F.lit("2020-01-01"), F.col("YEAR")))
    out = relate.dedupe_latest(claims, ["PATIENT_ID"])
    assert out.where(F.col("PATIENT_ID") == "HOT").count() == 1
    assert out.count() == claims.select("PATIENT_ID").distinct().count()


def test_upsert_with_many_null_keys(spark):
    path = shared_path(spark, "t-skew")
    src = _skewed_claims(spark).select(
        F.when(F.col("PATIENT_ID").isNull(), F.lit(None).cast("string")).otherwise(F.col("CLAIM_ID")).alias("CLAIM_ID"),
        "YEAR", F.lit("v1").alias("V"))
    upsert(spark, src, path)
    upsert(spark, src.withColumn("V", F.lit("v2")), path)
    back = spark.read.parquet(path)
    # non-NULL keys replaced once; the 3000 NULL-key rows are inserted again (they never match)
    assert back.where(F.col("CLAIM_ID").isNotNull()).count() == 6000
    assert back.where(F.col("CLAIM_ID").isNotNull() & (F.col("V") == "v1")).count() == 0
    assert back.where(F.col("CLAIM_ID").isNull()).count() == 6000


def test_session_has_aqe_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
