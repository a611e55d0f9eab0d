"""Physical-plan checks: lookups broadcast, pruned scans, no Python in plans,
partition pruning on gold reads."""

from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.operators import curate
from claimlake.operators.store import merge_into
from claimlake.plans import queries as q
from claimlake.session import shared_path
from claimlake.sources import claims_view as cv
from claimlake.sources import io
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_joins_are_broadcast(spark):
    s = curate.claims_enrich(cv.claims_bronze(spark, SF_SMALL), q._patients(spark, SF_SMALL),
                             q._products(spark, SF_SMALL))
    p = plan(s)
    assert p.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in p


def test_shuffle_join_above_bound_salts_null_keys(spark):
    s = curate.claims_enrich(cv.claims_bronze(spark, SF_SMALL), q._patients(spark, SF_SMALL),
                             q._products(spark, SF_SMALL), broadcast_max_rows=0)
    text = s._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in text  # NULL join keys are spread by a salt
    assert s.count() == cv.claims(spark, SF_SMALL).count()


def test_no_python_in_any_query_plan(spark):
    for name in ("q_entry_eligible_by_market", "q_market_split", "q_opioid_gold", "q_dedupe_claims",
                 "q_parse_manifest"):
        p = plan(q.queries()[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_prunes_columns(spark):
    df = cv.claims(spark, SF_SMALL).groupBy("MARKET_NAME").count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in text and "l_returnflag" not in text


def test_gold_year_read_is_partition_pruned(spark):
    base = shared_path(spark, "t-plan")
    names = [*schemas.GOLD_STORE_COLUMNS, "GOLD_TABLE"]
    data = [(i, y, t) for i, y, t in (("a", 2020, "naloxone"), ("b", 2021, "naloxone"), ("c", 2021, "opioid"))]
    df = spark.createDataFrame(data, "CLAIM_ID string, YEAR int, GOLD_TABLE string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in names if c not in df.columns})
    merge_into(spark, df, io.layer_path(base, "gold", io.GOLD_DATASET), partition_by=("GOLD_TABLE", "YEAR"))
    read = io.read_gold(spark, base, "naloxone", 2021)
    text = read._jdf.queryExecution().executedPlan().toString()
    pruned = text.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "= 2021" in pruned and "= naloxone" in pruned
    assert [r.CLAIM_ID for r in read.collect()] == ["b"]


def test_dedupe_is_an_aggregate_not_a_window(spark):
    p = plan(q._products(spark, SF_SMALL))
    assert "Window" not in p
    assert "Aggregate" in p
    assert F is not None


WRITING = {"q_upsert", "q_export_roundtrip", "q_gold_year_totals", "q_stream_gold_totals", "q_rerun_year",
           "q_upsert_null_keys", "q_upsert_duplicates", "q_upsert_small_delta", "q_gold_rows", "q_stream_gold_rows"}


def test_no_cross_joins_or_python_in_any_query(spark):
    bad = {}
    for name, fn in q.queries().items():
        if name in WRITING:
            continue
        p = plan(fn(spark, SF_SMALL))
        found = [n for n in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
                 if n in p]
        if found:
            bad[name] = found
    assert bad == {}
