from pyspark.sql import functions as F

from claimlake.functions import (differs_or_null, in_or_null, invalid_length, normalize_code, null_label,
                                 ratio_pct, remove_thousands, safe_cast)


def test_normalize_code_boundaries(spark):
    codes = [None, "", "1", "1234567890", "12345678901", "912345678901", "1234567890123"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = dict(df.select("c", normalize_code("c").alias("n")).collect())
    assert got[None] is None
    assert got[""] == "00000000000"
    assert got["1"] == "00000000001"
    assert got["1234567890"] == "01234567890"
    assert got["12345678901"] == "12345678901"
    assert got["912345678901"] == "12345678901"  # 12 characters: first one dropped
    assert got["1234567890123"] == "1234567890123"  # 13: left as is


def test_normalize_code_fallback_takes_lookup_code(spark):
    df = spark.createDataFrame([("12345678901", None), ("123", None), ("12345678901", "X")], "c string, k string")
    got = [r.n for r in df.select(normalize_code("c", fallback="k").alias("n")).collect()]
    assert got == [None, "00000000123", "X"]


def test_normalize_code_idempotent_and_width(spark):
    df = spark.range(1, 2000).select(F.col("id").cast("string").alias("c"))
    once = df.select(normalize_code("c").alias("c"))
    twice = once.select(normalize_code("c").alias("c"))
    assert once.exceptAll(twice).count() == 0
    assert once.where(F.length("c") != 11).count() == 0


def test_invalid_length_ignores_null(spark):
    df = spark.createDataFrame([("12345",), ("1234",), (None,)], "c string")
    assert df.where(invalid_length("c", 5)).count() == 1


def test_safe_cast_never_raises(spark):
    df = spark.createDataFrame([("12",), ("abc",), ("1,234",), (None,), ("2020-02-30",)], "c string")
    got = [r.i for r in df.select(safe_cast("c", "int").alias("i")).collect()]
    assert got == [12, None, None, None, None]
    dd = spark.createDataFrame([("2020-02-29",), ("2020-02-30",), ("abc",)], "c string")
    dates = [r.d for r in dd.select(safe_cast("c", "date").alias("d")).collect()]
    assert [d is None for d in dates] == [False, True, True]


def test_null_aware_predicates(spark):
    df = spark.createDataFrame([("VET",), ("S1",), (None,)], "c string")
    assert sorted(df.where(differs_or_null("c", "VET")).collect(), key=str) == sorted(
        [r for r in df.collect() if r.c != "VET"], key=str)
    assert df.where(in_or_null("c", ["S1"])).count() == 2
    assert [r.l for r in df.select(null_label("c", "Missing").alias("l")).collect()] == ["VET", "S1", "Missing"]


def test_remove_thousands_and_ratio(spark):
    df = spark.createDataFrame([("1,234,567", 1, 3), ("12", 0, 0)], "s string, a int, b int")
    got = df.select(remove_thousands("s").alias("s"), ratio_pct("a", "b").alias("p")).collect()
    assert got[0].s == "1234567" and got[0].p == 33.33
    assert got[1].p is None
