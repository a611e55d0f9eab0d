from claimlake.operators import quality
from claimlake.sources import io
from tests.conftest import rows


def test_parse_manifest_edge_cases(spark):
    raw = spark.createDataFrame([
        ("OPI_FactRx_201501.txt", "1,234"), ("OPI_Patient.txt", "12"), ("README", "abc"),
        (None, None), ("ADD_Product.txt", "1,234,567"),
    ], "FileName string, `RecordCount(With Header Record)` string")
    got = [tuple(r) for r in io.parse_manifest(raw).collect()]
    assert got == [("opi", "factrx", "201501", 1234), ("opi", "patient", None, 12),
                   ("readme", None, None, None), (None, None, None, None), ("add", "product", None, 1234567)]


def _manifest(spark, rows_):
    return spark.createDataFrame(rows_, "MARKET string, DATA_TYPE string, MONTH_ID string, RECORD_COUNT int")


def test_row_count_check_statuses(spark):
    df = spark.range(4)
    m = _manifest(spark, [("opi", "patient", None, 5), ("opi", "product", None, 9),
                          ("opi", "factrx", "1", 3), ("opi", "factrx", "2", 5)])
    status = lambda t: quality.row_count_check(df, m, t).first()
    assert (status("patient").STATUS, status("patient").ACTUAL_COUNT) == ("match", 5)
    assert status("product").STATUS == "mismatch"
    assert status("other").STATUS == "no_expected"
    assert status("factrx").STATUS == "ambiguous"


def test_reconcile_months(spark):
    claims = spark.createDataFrame([("201501",), ("201501",), ("201502",), (None,)], "MONTH_ID string")
    m = _manifest(spark, [("o", "factrx", "201501", 3), ("o", "factrx", "201503", 5), ("o", "patient", None, 9)])
    full = rows(quality.reconcile_months(claims, m))
    assert full == [(None, 1, None, None, "only_actual"), ("201501", 2, 2, 0, "match"),
                    ("201502", 1, None, None, "only_actual"), ("201503", None, 4, None, "only_expected")]
    assert rows(quality.reconcile_months(claims, m, how="inner")) == [("201501", 2, 2, 0, "match")]


def test_missing_counts_and_key_profile(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, None)], "k string, v int")
    assert quality.missing_counts(df).first().asDict() == {"k": 1, "v": 2}
    assert rows(quality.missing_counts(df, long=True)) == [("k", 1), ("v", 2)]
    kp = quality.key_profile(df, "k").first().asDict()
    assert kp == {"rows": 3, "distinct_keys": 1, "null_keys": 1, "distinct_with_null": 2}


def test_pivot_counts_explicit_values(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (2, None), (2, "Q")], "m int, mk string")
    out = rows(quality.pivot_counts(df, ["m"], "mk", ["A", "B", "Z"]))
    assert out == [(1, 2, 1, None, None, None), (2, None, None, None, 1, 1)]  # all five rows are in some column


def test_frequency_valid_values_lengths_profile(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("AL",), ("PR",), ("PR",), (None,)], "s string")
    assert [tuple(r) for r in quality.frequency(df, "s", order="count_desc").collect()] == [
        ("PR", 2), (None, 1), ("AL", 1)]
    vv = rows(quality.valid_values(df, "s", ["AL"]))
    assert vv == [(None, 1, False), ("AL", 1, True), ("PR", 2, False)]
    assert quality.length_violations(df, {"s": 3}).first().s == 3
    assert quality.profile(df, {"pr": F.col("s") == "PR"}).first().asDict() == {"rows": 4, "pr": 2}


def test_schema_check_counts_the_table(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, "y", None)], "a int, b string, x double")
    out = quality.schema_check(df, {"a": "int", "b": "date", "c": "string"})
    assert rows(out, "column", "expected_type", "actual_type", "status", "rows", "filled") == [
        ("a", "int", "int", "ok", 2, 2), ("b", "date", "string", "retyped", 2, 1),
        ("c", "string", None, "missing", 2, 0), ("x", None, "double", "extra", 2, 1)]
    assert rows(quality.schema_diff(df, {"a": "int", "b": "string", "x": "double"})) == []
