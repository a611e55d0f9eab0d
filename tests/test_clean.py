import pytest

from claimlake.operators import clean


def test_exclude_value_keeps_null(spark):
    df = spark.createDataFrame([("VET",), ("S1",), (None,)], "c string")
    assert clean.exclude_value(df, "c", "VET").count() == 2
    assert clean.exclude_value(df, "c", "VET", keep_null=False).count() == 1


def test_keep_in_and_outside_partition_the_input(spark):
    df = spark.createDataFrame([("AL",), ("PR",), (None,), ("GU",), ("NY",)], "c string")
    kept = clean.keep_in(df, "c", ["AL", "NY"])
    out = clean.outside(df, "c", ["AL", "NY"])
    nulls = df.where("c is null").count()
    assert kept.count() == 3  # AL, NY, NULL
    assert out.count() == 2  # PR, GU; NULL is not "outside"
    assert kept.count() + out.count() == df.count()
    assert clean.keep_in(df, "c", ["AL", "NY"], keep_null=False).count() + out.count() + nulls == df.count()


def test_upper_columns_clash_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a int, A int")
    with pytest.raises(ValueError, match="both become"):
        clean.upper_columns(df)
    assert clean.upper_columns(spark.createDataFrame([(1,)], "ingestion_date int")).columns == ["INGESTION_DATE"]


def test_conform_raises_on_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.conform(df, ["b"]).columns == ["b"]
    with pytest.raises(ValueError, match="missing"):
        clean.conform(df, ["a", "c"])


def test_cast_types_and_rejects(spark):
    df = spark.createDataFrame([("1.5", "3"), ("x", None), (None, "7d")], "q string, d string")
    types = {"q": "double", "d": "int"}
    out = clean.cast_types(df, types).collect()
    assert [(r.q, r.d) for r in out] == [(1.5, 3), (None, None), (None, None)]
    rej = clean.cast_rejects(df, types).first()
    assert (rej.q, rej.d) == (1, 1)


def test_stamp_and_align_variant(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert clean.stamp(df, "2024-12-31").first().UPDATE_DATE == "2024-12-31"
    assert len(clean.stamp(df).first().UPDATE_DATE) == 10
    out = clean.align_variant(df, {"PAT_DX_AVAIL_FLAG": (" ", "string"), "a": (9, "int")})
    assert out.first().asDict() == {"a": 1, "PAT_DX_AVAIL_FLAG": " "}
