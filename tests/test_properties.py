"""Property tests (hypothesis): code repair and upsert semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlake.functions.codes import normalize_code
from claimlake.operators.upsert import upsert
from claimlake.session import shared_path

SLOW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(st.lists(st.text(alphabet="0123456789", min_size=0, max_size=12), min_size=1, max_size=60))
def test_normalize_code_width_and_idempotence(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    once = df.select(normalize_code("c").alias("n"))
    got = [r.n for r in once.collect()]
    assert all(len(n) == 11 for n in got)
    again = [r.n for r in once.select(normalize_code("n").alias("n")).collect()]
    assert again == got
    for c, n in zip(codes, got):
        assert n.endswith(c[1:] if len(c) == 12 else c)


_batch = st.dictionaries(st.integers(0, 30), st.integers(0, 9), min_size=1, max_size=25)


@SLOW
@given(st.lists(st.tuples(_batch, st.sampled_from([2020, 2021])), min_size=1, max_size=3))
def test_upsert_is_last_writer_wins(spark, batches):
    path = shared_path(spark, "t-prop")
    expected: dict[tuple[str, int], str] = {}
    for i, (batch, year) in enumerate(batches):
        rows = [(f"k{k}", year, f"{i}:{v}") for k, v in batch.items()]
        upsert(spark, spark.createDataFrame(rows, "CLAIM_ID string, YEAR int, V string"), path)
        expected.update({(k, y): v for k, y, v in rows})
    back = spark.read.schema("CLAIM_ID string, YEAR int, V string").parquet(path)
    got = {(r.CLAIM_ID, r.YEAR): r.V for r in back.collect()}
    assert back.count() == len(got)  # one row per key
    assert got == expected
    assert back.where(F.col("CLAIM_ID").isNull()).count() == 0
