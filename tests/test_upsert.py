import time
from pathlib import Path

import pytest

from claimlake.operators import upsert as upserts
from claimlake.operators.relate import assert_unique
from claimlake.operators.upsert import table_exists, upsert
from claimlake.session import SPARING, materialize, shared_path
from tests.conftest import rows

SCHEMA = "CLAIM_ID string, YEAR int, V string"


def _read(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path), "CLAIM_ID", "YEAR", "V")


def test_upsert_merge_semantics(spark):
    path = shared_path(spark, "t-upsert")
    assert not table_exists(spark, path)
    first = spark.createDataFrame([("a", 2020, "v1"), ("b", 2020, "v1"), ("a", 2021, "v1"), (None, 2020, "n1")], SCHEMA)
    upsert(spark, first, path)
    assert table_exists(spark, path)
    src = spark.createDataFrame([("a", 2020, "v2"), ("c", 2020, "v2"), (None, 2020, "n2")], SCHEMA)
    upsert(spark, src, path)
    got = _read(spark, path)
    # a/2020 updated, b/2020 kept, a/2021 (same id, other year) kept, c inserted, NULL key inserted again
    assert got == [(None, 2020, "n1"), (None, 2020, "n2"), ("a", 2020, "v2"), ("a", 2021, "v1"),
                   ("b", 2020, "v1"), ("c", 2020, "v2")]
    upsert(spark, src, path)  # re-run: same, except one more NULL-key row
    again = _read(spark, path)
    assert [r for r in again if r[0] is not None] == [r for r in got if r[0] is not None]
    assert sum(r[0] is None for r in again) == 3


def test_upsert_leaves_untouched_years(spark):
    path = shared_path(spark, "t-upsert")
    upsert(spark, spark.createDataFrame([("a", 2019, "x"), ("a", 2020, "x")], SCHEMA), path)
    upsert(spark, spark.createDataFrame([("b", 2020, "y")], SCHEMA), path)
    assert _read(spark, path) == [("a", 2019, "x"), ("a", 2020, "x"), ("b", 2020, "y")]


def test_upsert_duplicate_source_keys(spark):
    dup = spark.createDataFrame([("a", 2020, "1"), ("a", 2020, "2")], SCHEMA)
    with pytest.raises(ValueError):
        upsert(spark, dup, shared_path(spark, "t-upsert"), on_duplicate="error")
    p = shared_path(spark, "t-upsert")
    with pytest.raises(ValueError, match="latest"):
        upsert(spark, dup, p, on_duplicate="latest")
    upsert(spark, dup, p, on_duplicate="latest", latest="V")
    assert _read(spark, p) == [("a", 2020, "2")]
    p = shared_path(spark, "t-upsert")
    upsert(spark, dup, p, on_duplicate="keep")
    upsert(spark, dup, p, on_duplicate="keep")
    assert _read(spark, p) == [("a", 2020, "1"), ("a", 2020, "2")]  # idempotent


def test_upsert_rejects_bad_partition_count(spark):
    with pytest.raises(ValueError, match="greater than or equal to 1"):
        upsert(spark, spark.createDataFrame([("a", 2020, "1")], SCHEMA), shared_path(spark, "t"), num_partitions=0)


def test_upsert_keeps_rows_without_a_year_and_checks_columns(spark):
    path = shared_path(spark, "t-upsert")
    upsert(spark, spark.createDataFrame([("a", None, "1"), ("c", 2020, "1")], SCHEMA), path)
    upsert(spark, spark.createDataFrame([("b", None, "2"), ("c", 2020, "2")], SCHEMA), path)
    assert _read(spark, path) == [("a", None, "1"), ("b", None, "2"), ("c", 2020, "2")]
    wide = spark.createDataFrame([("a", 2020, "1", "w")], SCHEMA + ", W string")
    with pytest.raises(ValueError, match="extra"):
        upsert(spark, wide, path)
    wider = shared_path(spark, "t-upsert")
    upsert(spark, wide, wider)
    with pytest.raises(ValueError, match="missing"):
        upsert(spark, spark.createDataFrame([("b", 2020, "1")], SCHEMA), wider)
    assert spark.read.parquet(wider).first().W == "w"


@pytest.mark.parametrize("small", [500_000, 0])
def test_a_merge_moves_the_stored_rows_once(spark, monkeypatch, small):
    monkeypatch.setattr(upserts, "SMALL_DELTA_ROWS", small)
    path = shared_path(spark, "t-upsert-once")
    first = [(f"k{i % 40}" if i % 5 else None, 2000 + i % 3 if i % 7 else None, f"a{i}") for i in range(100)]
    second = [(f"k{i}" if i % 6 else None, 2000 + i % 3, f"b{i}") for i in range(30)]
    merged = []
    frames = upserts.merge_frames
    monkeypatch.setattr(upserts, "merge_frames", lambda *a, **kw: merged.append(frames(*a, **kw)) or merged[-1])
    upsert(spark, spark.createDataFrame(first, SCHEMA), path, on_duplicate="keep")
    upsert(spark, spark.createDataFrame(second, SCHEMA), path, on_duplicate="keep")
    new = {r[:2] for r in second if r[0] is not None}
    want = [r for r in first if r[:2] not in new] + second
    assert _read(spark, path) == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))
    plan = merged[0]._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) == (small == 0), plan


@pytest.mark.parametrize("most", [16_384, 0])
def test_only_keys_move_in_a_large_merge(spark, monkeypatch, most):
    monkeypatch.setattr(upserts, "SMALL_DELTA_ROWS", 0)
    monkeypatch.setattr(upserts, "MAX_BITMAPS", most)
    path = shared_path(spark, "t-upsert-places")
    key, year = "case when id % 11 > 0 then concat('k', id % 60000) end as CLAIM_ID", "case when id % 13 > 0 then cast(2000 + id % 2 as int) end as YEAR"
    first = spark.range(70_000).coalesce(1).selectExpr(key, year, "concat('a', id) as V")  # keys repeat; more rows in a file than a bitmap has
    second = spark.range(0, 70_000, 3).selectExpr(key, year, "concat('b', id) as V")
    merged = []
    frames = upserts.merge_frames
    monkeypatch.setattr(upserts, "merge_frames", lambda *a, **kw: merged.append(frames(*a, **kw)) or merged[-1])
    upsert(spark, first, path, on_duplicate="keep")
    new = rows(second, "CLAIM_ID", "YEAR", "V")
    keys = {r[:2] for r in new if r[0] is not None and r[1] is not None}
    want = sorted([r for r in rows(first, "CLAIM_ID", "YEAR", "V") if r[:2] not in keys] + new, key=lambda t: tuple((x is not None, x) for x in t))
    upsert(spark, second, path, on_duplicate="keep")
    assert _read(spark, path) == want
    assert ("LeftAnti" in merged[0]._jdf.queryExecution().executedPlan().toString()) == (most == 0)


def test_a_merge_leaves_no_shuffled_rows_and_the_settings(spark):
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {p.name for d in dirs for p in Path(d).glob("*/shuffle_*.data")}

    before, settings = shuffled(), [spark.conf.get(k, None) for k in SPARING]
    path = shared_path(spark, "t-upsert-sparing")
    upsert(spark, spark.range(1000).selectExpr("concat('k', id) as CLAIM_ID", "cast(2000 + id % 3 as int) as YEAR", "'v' as V"), path, on_duplicate="keep")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    assert [spark.conf.get(k, None) for k in SPARING] == settings


def test_rows_of_repeated_keys_alone_move_to_find_the_latest(spark, monkeypatch):
    key, year = "case when id % 11 > 0 then concat('k', id % 60000) end as CLAIM_ID", "case when id % 13 > 0 then cast(2000 + id % 2 as int) end as YEAR"
    df = spark.range(70_000).coalesce(1).selectExpr(key, year, "concat('a', id % 7, '-', id) as V")  # the latest by V is not the last
    kept = rows(assert_unique(df, ("CLAIM_ID", "YEAR"), "latest", "V"), "CLAIM_ID", "YEAR", "V")
    assert upserts._latest(df, ("CLAIM_ID", "YEAR"), "V") is None  # fits a broadcast
    monkeypatch.setattr(upserts, "SMALL_DELTA_ROWS", 0)
    assert upserts._latest(df, ("CLAIM_ID", "YEAR"), "V") is None  # not read from files
    source = materialize(df, "t-upsert-latest")
    found = upserts._latest(source, ("CLAIM_ID", "YEAR"), "V")
    assert rows(found, "CLAIM_ID", "YEAR", "V") == kept and len(kept) < 70_000
    path = shared_path(spark, "t-upsert-latest")
    for _ in range(2):  # rows with a NULL in their key are added again
        upsert(spark, source, path, on_duplicate="latest", latest="V", stage_source=False)
    again = [r for r in kept if r[0] is None or r[1] is None]
    assert _read(spark, path) == sorted(kept + again, key=lambda t: tuple((x is not None, x) for x in t))
