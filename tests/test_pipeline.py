"""End-to-end run on the smallest tables, twice: the gold tables must not change."""

from claimlake import schemas
from claimlake.plans import jobs
from claimlake.session import shared_path
from claimlake.sources import claims_view as cv
from claimlake.sources import io
from tests.conftest import SF_SMALL, rows


def test_pipeline_twice_gives_same_gold(spark):
    base = shared_path(spark, "t-pipeline")
    p = jobs.RunParams(base=base, run_date="2024-12-31", on_duplicate="keep")
    manifest = jobs.manifest_job(spark, cv.manifest_raw(spark, SF_SMALL), p)
    pr = jobs.patient_job(spark, cv.patient_ref(spark, SF_SMALL), p, manifest)
    assert pr["row_count"].first().STATUS == "match"
    dr = jobs.product_job(spark, cv.product_ref(spark, SF_SMALL), p, manifest)
    assert dr["lengths_after"].first().NDC_CD == 0
    pats = io.read_layer(spark, base, "silver", "patient_ref")
    prods = io.read_layer(spark, base, "silver", "product_ref")
    cr = jobs.claims_job(spark, cv.claims_bronze(spark, SF_SMALL), pats, prods, p, manifest)
    assert cr["summary_QUANTITY"].count() == 9
    silver = io.read_layer(spark, base, "silver", "claims")
    look = (cv.benzo_def(spark, SF_SMALL), cv.opioid_def(spark, SF_SMALL), cv.mme(spark, SF_SMALL))
    first = rows(jobs.gold_job(spark, silver, *look, p)["year_totals"])
    snapshot = {t: rows(io.read_gold(spark, base, t)) for t in schemas.GOLD_MARKETS}
    second = rows(jobs.gold_job(spark, silver, *look, p)["year_totals"])
    assert first == second
    assert snapshot == {t: rows(io.read_gold(spark, base, t)) for t in schemas.GOLD_MARKETS}
    quarantined = jobs.read_quarantine(spark, p).count()
    routed = sum(c for _, _, c in first)
    assert routed + quarantined == silver.count()
    paths = jobs.export_job(spark, p, f"{base}/exports", tables=["naloxone"])
    back = spark.read.option("header", True).csv(paths[0])
    assert back.count() == io.read_gold(spark, base, "naloxone").count()
