"""One schema over years that were written with different ones."""

import pytest
from pyspark.sql import types as T

from claimlake.operators import reconcile as r
from claimlake.session import shared_path
from claimlake.sources import io
from tests.conftest import rows


def ddl(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize("a, b, want", [
    ("tinyint", "bigint", "bigint"), ("int", "double", "double"), ("int", "float", "double"), ("smallint", "float", "float"),
    ("float", "double", "double"), ("bigint", "double", None), ("bigint", "float", None), ("decimal(10,2)", "int", "decimal(12,2)"),
    ("decimal(5,2)", "decimal(4,3)", "decimal(6,3)"), ("decimal(38,0)", "decimal(10,9)", None), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("date", "string", None), ("string", "int", None), ("string", "string", "string"), ("decimal(5,2)", "double", None)])
def test_wider_types(spark, a, b, want):
    got = [r.wider(ddl(x), ddl(y)) for x, y in ((a, b), (b, a))]
    assert [x and x.simpleString() for x in got] == [want, want]


def test_years_read_as_one(spark):
    path = shared_path(spark, "t-years")
    spark.createDataFrame([(1, "a"), (None, "b")], "v int, k string").write.parquet(f"{path}/YEAR=02")
    spark.createDataFrame([(2**40,)], "v bigint").write.parquet(f"{path}/YEAR=03")
    spark.createDataFrame([(7, "c", 1.5)], "v smallint, k string, `w x` double").write.parquet(f"{path}/YEAR=11")
    spark.createDataFrame([], "v int").write.parquet(f"{path}/YEAR=12")
    df = r.read_years(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "string", "double", "string"]
    assert rows(df) == [(None, "b", None, "02"), (1, "a", None, "02"), (7, "c", 1.5, "11"), (2**40, None, None, "03")]
    got = {(x.year, x.column): (x.stored_type, x.status, x.filled) for x in r.report(spark, path).collect()}
    assert got["02", "v"] == ("int", "widened", 1) and got["03", "k"] == (None, "missing", 0) and got["11", "k"] == ("string", "added", 1)
    assert got["11", "w x"] == ("double", "added", 1) and got["12", "v"] == ("int", "widened", 0) and len(got) == 12


def test_conflicts(spark):
    path = shared_path(spark, "t-conflict")
    spark.createDataFrame([(1, 1)], "v int, k int").write.parquet(f"{path}/YEAR=2020")
    spark.createDataFrame([("x", 2)], "v string, k int").write.parquet(f"{path}/YEAR=2021")
    with pytest.raises(r.SchemaConflict, match="'v'"):
        r.read_years(spark, path)
    assert rows(r.read_years(spark, path, strict=False)) == [("1", 1, "2020"), ("x", 2, "2021")]
    with pytest.raises(r.SchemaConflict, match="case"):
        r.plan({"1": ddl("a int"), "2": ddl("A int")})
    assert r.plan({}) == []


def test_partition_values_have_no_stored_type(spark):
    base = shared_path(spark, "t-codes")
    df = spark.createDataFrame([(1, 2020, "02"), (2, 2020, "03")], "v int, YEAR int, CODE string")
    for _ in range(2):
        io.write_year(df, base, "silver", "t", ("CODE",))
    assert rows(io.read_layer(spark, base, "silver", "t", schema=df.schema)) == [(1, 2020, "02"), (2, 2020, "03")]
    with pytest.raises(ValueError, match="schema change"):
        io.write_year(df.selectExpr("cast(v as string) as v", "YEAR", "CODE"), base, "silver", "t", ("CODE",))
