"""The bucketed store: merge semantics, what a delta touches, replays, deletions."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.operators import store
from claimlake.operators.store import layout, merge_into, read_store, rebucket
from claimlake.plans import jobs
from claimlake.plans import queries as q
from claimlake.session import shared_path
from claimlake.sources import claims_view as cv
from claimlake.sources import io
from claimlake.streaming import incremental
from tests.conftest import SF_SMALL, rows

SCHEMA = "CLAIM_ID string, YEAR int, GOLD_TABLE string, V string, D int"
PARTS = ("GOLD_TABLE", "YEAR")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def merge(spark, data, path, **kw):
    kw = {"partition_by": PARTS, "buckets": 4} | kw
    return merge_into(spark, frame(spark, data) if isinstance(data, list) else data, path, **kw)


def test_merge_semantics_over_tables_and_years(spark):
    path = shared_path(spark, "t-store")
    merge(spark, [("a", 2020, "x", "1", 0), ("b", 2020, "x", "1", 0), ("a", 2021, "x", "1", 0), ("a", 2020, "y", "1", 0)], path)
    merge(spark, [("a", 2020, "x", "2", 0), ("c", 2020, "x", "2", 0), ("d", 2022, "z", "2", 0)], path)
    want = sorted([("a", 2020, "x", "2", 0), ("b", 2020, "x", "1", 0), ("a", 2021, "x", "1", 0), ("a", 2020, "y", "1", 0), ("c", 2020, "x", "2", 0), ("d", 2022, "z", "2", 0)])
    assert rows(read_store(spark, path)) == want
    assert layout(spark, path).buckets == 4 and layout(spark, shared_path(spark, "none")) is None
    merge(spark, [], path)  # nothing delivered
    assert rows(read_store(spark, path)) == want


def test_random_deltas_equal_a_dictionary(spark):
    r, path, want = random.Random(1), shared_path(spark, "t-store"), {}
    for n in range(4):
        delta = {(f"c{r.randint(0, 60)}", r.choice([2020, 2021]), r.choice("xy")): (str(n), n) for _ in range(30)}
        merge(spark, [(*k, *v) for k, v in delta.items()], path)
        want |= delta
    assert rows(read_store(spark, path)) == sorted((*k, *v) for k, v in want.items())


def _files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/GOLD_TABLE=*/YEAR=*/BUCKET=*/*.parquet")}


def test_untouched_buckets_are_neither_read_nor_written(spark):
    path = shared_path(spark, "t-store")
    merge(spark, [(f"c{i}", 2020 + i % 2, "x", "1", 0) for i in range(200)], path, buckets=8)
    before = _files(path)
    number = frame(spark, [("c0", 2020, "x", "2", 0)]).select(F.pmod(F.xxhash64("CLAIM_ID"), F.lit(8))).first()[0]
    touched = f"/GOLD_TABLE=x/YEAR=2020/BUCKET={number}/"
    for f in before:  # a reader of any other bucket would fail
        if touched not in f:
            with open(f, "wb") as out:
                out.write(b"not a Parquet file")
    after_damage = _files(path)
    merge(spark, [("c0", 2020, "x", "2", 0)], path)
    after = _files(path)
    assert {f for f in before if touched not in f} == {f for f in after if touched not in f}
    assert all(after[f] == after_damage[f] for f in after if touched not in f)
    assert not {f for f in before if touched in f} & set(after)
    mine = spark.read.schema(layout(spark, path).stored).parquet(path).where(f"YEAR = 2020 AND BUCKET = {number}")
    assert mine.where("CLAIM_ID = 'c0'").first().V == "2" and mine.count() > 1


def test_rows_without_a_key_are_added_once_a_run(spark):
    path = shared_path(spark, "t-store")
    data = [(None, 2020, "x", "n", 0), ("a", None, "x", "n", 0), ("b", 2020, "x", "1", 0)]
    merge(spark, data, path, run="first")
    merge(spark, data, path, run="first")  # a replay
    assert rows(read_store(spark, path)) == sorted(data, key=lambda t: tuple((x is not None, x) for x in t))
    merge(spark, data, path, run="second")
    merge(spark, data, path)
    merge(spark, data, path)  # unnamed runs are runs of their own
    assert read_store(spark, path).where("CLAIM_ID IS NULL").count() == 4
    assert read_store(spark, path).where("YEAR IS NULL").count() == 4
    assert read_store(spark, path).where("CLAIM_ID = 'b'").count() == 1


def test_latest_does_not_depend_on_the_order_of_deliveries(spark):
    r = random.Random(5)
    data = [(f"c{r.randint(0, 9)}", 2020, "x", str(i), r.choice([None, 1, 2, 3])) for i in range(60)]
    want = {}
    for row in data:
        key = (row[4] is not None, row[4] or 0, row[3])
        if row[0] not in want or key > want[row[0]][0]:
            want[row[0]] = (key, row)
    for order in (1, 2, 3):
        r = random.Random(order)
        some, path = r.sample(data, len(data)), shared_path(spark, "t-store")
        for at in range(0, 60, 20):
            merge(spark, some[at : at + 20], path, on_duplicate="latest", latest="D")
        merge(spark, some[20:40], path, on_duplicate="latest", latest="D")  # once more
        assert rows(read_store(spark, path)) == sorted(row for _, row in want.values())


def test_deletions_empty_folders_and_heed_versions(spark):
    path = shared_path(spark, "t-store")
    merge(spark, [("a", 2020, "x", "1", 3), ("b", 2020, "x", "1", 3), ("c", 2021, "x", "1", 3)], path, buckets=2)
    gone = spark.createDataFrame([("a", 2020), ("c", 2021), ("zz", 1999), (None, 2020)], "CLAIM_ID string, YEAR int").withColumn("GOLD_TABLE", F.lit("x"))
    merge(spark, [("d", 2020, "x", "1", 3)], path, gone=gone)
    assert rows(read_store(spark, path), "CLAIM_ID") == [("b",), ("d",)]
    early = gone.select(F.lit("b").alias("CLAIM_ID"), "YEAR", "GOLD_TABLE", F.lit(2).alias("D"))
    merge(spark, [], path, gone=early, on_duplicate="latest", latest="D")
    assert rows(read_store(spark, path), "CLAIM_ID") == [("b",), ("d",)]
    merge(spark, [], path, gone=early.withColumn("D", F.lit(3)), on_duplicate="latest", latest="D")
    assert rows(read_store(spark, path), "CLAIM_ID") == [("d",)]


def test_wrong_calls(spark):
    path = shared_path(spark, "t-store")
    with pytest.raises(ValueError, match="greater than or equal to 1"):
        merge(spark, [], path, buckets=0)
    with pytest.raises(ValueError, match="no keyed table"):
        read_store(spark, path)
    with pytest.raises(ValueError, match="duplicate key"):
        merge(spark, [("a", 2020, "x", "1", 0), ("a", 2020, "x", "2", 0)], path)
    merge(spark, [("a", 2020, "x", "1", 0), ("a", 2020, "y", "2", 0)], path)  # keys are of a table
    with pytest.raises(ValueError, match="extra"):
        merge(spark, frame(spark, []).withColumn("W", F.lit(1)), path)
    with pytest.raises(ValueError, match="missing"):
        merge(spark, frame(spark, []).drop("V"), path)
    with pytest.raises(ValueError, match="other types"):
        merge(spark, frame(spark, []).withColumn("D", F.lit("x")), path)
    with pytest.raises(ValueError, match="partitions"):
        merge(spark, [], path, partition_by=("YEAR",))
    with pytest.raises(ValueError, match="latest"):
        merge(spark, [], path, on_duplicate="latest")


def test_number_of_buckets_and_rebucket(spark, monkeypatch):
    monkeypatch.setattr(store, "ROWS_PER_BUCKET", 10)
    path, to = shared_path(spark, "t-store"), shared_path(spark, "t-store")
    data = [(f"c{i}", 2020, "x", "1", 0) for i in range(35)] + [(None, 2020, "x", "n", 0)]
    merge(spark, data, path, buckets=None, run="r")
    assert layout(spark, path).buckets == 4
    rebucket(spark, path, to, 7)
    assert layout(spark, to).buckets == 7 and rows(read_store(spark, to)) == rows(read_store(spark, path))
    merge(spark, [("c3", 2020, "x", "2", 0), (None, 2020, "x", "n", 0)], to, run="r")
    assert read_store(spark, to).count() == 36 and read_store(spark, to).where("V = '2'").count() == 1


def test_partition_values_stay_as_they_are(spark):
    path = shared_path(spark, "t-store")
    merge_into(spark, spark.createDataFrame([("a", "02")], "CLAIM_ID string, YEAR string"), path)
    merge_into(spark, spark.createDataFrame([("a", "02"), ("a", "2")], "CLAIM_ID string, YEAR string"), path)
    assert rows(read_store(spark, path)) == [("a", "02"), ("a", "2")]


def _lookups(spark):
    return cv.benzo_def(spark, SF_SMALL), cv.opioid_def(spark, SF_SMALL), cv.mme(spark, SF_SMALL)


def test_gold_takes_few_jobs_for_all_tables(spark):
    """All eleven tables and the quarantine in one write each: the number of jobs doesn't grow with the tables."""
    base = shared_path(spark, "t-gold")
    p = jobs.RunParams(base=base, run_date="2024-12-31", on_duplicate="keep")
    io.write_layer(q._silver(spark, SF_SMALL), base, "silver", "claims", ("YEAR", "MARKET_NAME"))
    silver = io.read_layer(spark, base, "silver", "claims")
    jobs.gold_job(spark, silver, *_lookups(spark), p)
    spark.sparkContext.setJobGroup("gold", "gold")
    jobs.gold_job(spark, silver, *_lookups(spark), p)["year_totals"].collect()
    spark.sparkContext.setJobGroup("", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("gold")) <= 50


def test_routed_equals_the_market_frames(spark):
    """The one routed pass gives each gold table's and the quarantine's rows."""
    from claimlake.operators import markets
    g, look = q._gold_input(spark, SF_SMALL), _lookups(spark)
    routed = markets.routed(g, *look, "2024-12-31").cache()
    enriched = markets.mme_enrich(g, look[2])
    split = markets.benzo_split(g, look[0])
    frames = [markets.non_opioid_gold(g, "2024-12-31"), markets.naloxone_gold(g, "2024-12-31"), markets.benzo_gold(split, "2024-12-31"),
              markets.buprenorphine_gold(enriched, look[1], "2024-12-31"), markets.opioid_gold(enriched, look[1], "2024-12-31")]
    for f in frames:
        tables = [r[0] for r in f.select("GOLD_TABLE").distinct().collect()]
        assert rows(routed.where(F.col("GOLD_TABLE").isin(tables)), *f.columns) == rows(f)
    left = markets.unrouted(g, split, enriched, look[1])
    assert rows(routed.where("GOLD_TABLE IS NULL"), *left.columns) == rows(left)
    routed.unpersist()


def test_a_claim_leaves_quarantine_when_it_is_routed(spark):
    base = shared_path(spark, "t-quarantine")
    p = jobs.RunParams(base=base, run_date="2024-12-31", on_duplicate="latest", latest="DISPENSE_DATE")
    benzo, opioid, mme = _lookups(spark)
    silver = q._silver(spark, SF_SMALL)
    jobs.write_markets(spark, silver, benzo, opioid.where("false"), mme, p)
    before = jobs.read_quarantine(spark, p).where("REASON = 'no_market_definition'").count()
    jobs.write_markets(spark, silver, benzo, opioid, mme, p)
    after = jobs.read_quarantine(spark, p).where("REASON = 'no_market_definition'").count()
    assert 0 < after < before
    fresh = jobs.RunParams(base=shared_path(spark, "t-quarantine"), run_date="2024-12-31", on_duplicate="latest", latest="DISPENSE_DATE")
    jobs.write_markets(spark, silver, benzo, opioid, mme, fresh)
    assert rows(jobs.read_quarantine(spark, p)) == rows(jobs.read_quarantine(spark, fresh))


def test_replayed_batch_adds_no_null_keys(spark):
    base = shared_path(spark, "t-null")
    p = jobs.RunParams(base=base, run_date="2024-12-31", on_duplicate="latest", latest="DISPENSE_DATE")
    look = (q._patients(spark, SF_SMALL), q._products(spark, SF_SMALL), *_lookups(spark))
    bronze = cv.claims_bronze(spark, SF_SMALL)
    batch = bronze.withColumn("CLAIM_ID", F.when(F.col("DAYS_SUPPLY") != 30, F.col("CLAIM_ID")))
    incremental.upsert_batch(batch, *look, p, "ckpt/0")
    stored = lambda: (rows(read_store(spark, io.layer_path(base, "gold", io.GOLD_DATASET))), rows(jobs.read_quarantine(spark, p)))
    first = stored()
    incremental.upsert_batch(batch, *look, p, "ckpt/0")
    assert stored() == first and any(r[3] is None for r in first[0]) and any(r[0] is None for r in first[1])
    assert schemas.GOLD_STORE_COLUMNS[3] == "CLAIM_ID"


def test_nothing_is_deleted_from_a_table_just_made(spark, monkeypatch):
    staged = []
    keep = store.materialize
    monkeypatch.setattr(store, "materialize", lambda df, *parts: staged.append(parts[0]) or keep(df, *parts))
    path = shared_path(spark, "t-store-fresh")
    df = spark.createDataFrame([("a", 2020, 1), ("b", 2021, 2)], "CLAIM_ID string, YEAR int, V int")
    for n in range(2):
        merge_into(spark, df, path, buckets=2, gone=spark.createDataFrame([("a", 2020), ("c", 2020)], "CLAIM_ID string, YEAR int"))
        assert ("store-gone" in staged) == (n == 1)  # the second merge has stored rows to delete
        assert rows(read_store(spark, path)) == rows(df)


def test_a_merge_by_version_moves_rows_once(spark):
    found = store.Layout(4, ("CLAIM_ID", "YEAR"), PARTS, frame(spark, []).schema)
    df = store.bucketed(frame(spark, [("a", 2020, "x", "1", 1), ("a", 2020, "x", "2", 2)]), found)
    out = store.latest_by_folder(df, found, "D", 3)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert [r.V for r in out.collect()] == ["2"]


def test_merges_by_version_in_parts_of_folders(spark, monkeypatch):
    """Folders dealt in parts, a key with most of the rows, and rows without a key."""
    monkeypatch.setattr(store, "CHUNK_ROWS", 5)
    reduced, whole = [], store.dedupe_latest
    monkeypatch.setattr(store, "dedupe_latest", lambda *a: reduced.append(1) or whole(*a))
    r = random.Random(7)
    data = [(f"c{r.randint(0, 30)}", r.choice([2020, 2021]), r.choice("xy"), str(i), r.choice([None, 1, 2, 3])) for i in range(200)]
    data += [("hot", 2020, "x", str(i), 1) for i in range(300)] + [(None, 2020, "x", "n", 1)] * 2
    r.shuffle(data)
    path, want = shared_path(spark, "t-store"), {}
    for n, at in enumerate((0, 250)):
        merge(spark, data[at : at + 252], path, on_duplicate="latest", latest="D", run=f"r{n}")
    for row in data[:502]:
        key = (row[4] is not None, row[4] or 0, row[3])
        if row[0] is not None and (row[:3] not in want or key > want[row[:3]][0]):
            want[row[:3]] = (key, row)
    assert reduced and rows(read_store(spark, path).where("CLAIM_ID IS NOT NULL")) == rows(frame(spark, [row for _, row in want.values()]))
    assert read_store(spark, path).where("CLAIM_ID IS NULL").count() >= 2
