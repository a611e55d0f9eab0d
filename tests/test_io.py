import pytest
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.operators import quality
from claimlake.session import shared_path
from claimlake.sources import claims_view as cv
from claimlake.sources import io
from tests.conftest import SF_SMALL, rows


def test_read_manifest_and_parse(spark):
    path = shared_path(spark, "t-io")
    raw = cv.manifest_raw(spark, SF_SMALL).withColumnRenamed("RECORD_COUNT_RAW", "RecordCount(With Header Record)")
    raw.write.option("header", True).csv(path)
    back = io.read_manifest(spark, path)
    assert back.schema == schemas.MANIFEST_RAW_SCHEMA
    parsed = io.parse_manifest(back)
    assert rows(parsed) == rows(io.parse_manifest(raw))
    assert parsed.where("DATA_TYPE = 'patient'").first().RECORD_COUNT == cv.patient_ref(spark, SF_SMALL).count() + 1


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_read_lookup_keeps_leading_zeros(spark, fmt):
    path = shared_path(spark, "t-io")
    d = cv.benzo_def(spark, SF_SMALL)
    (d.write.option("header", True).csv(path) if fmt == "csv" else d.write.parquet(path))
    back = io.read_lookup(spark, path, schemas.BENZO_DEF_SCHEMA, fmt)
    assert rows(back) == rows(d)
    assert back.where(F.length("NDC") != 11).count() == 0
    with pytest.raises(ValueError):
        io.read_lookup(spark, path, schemas.BENZO_DEF_SCHEMA, "xlsx")


def test_write_layer_schema_guard_and_dynamic_overwrite(spark):
    base = shared_path(spark, "t-io")
    a = spark.createDataFrame([("x", 2020), ("y", 2021)], "K string, YEAR int")
    io.write_layer(a, base, "silver", "t")
    io.write_layer(spark.createDataFrame([("z", 2021)], "K string, YEAR int"), base, "silver", "t",
                   allow_schema_change=False)
    assert rows(io.read_layer(spark, base, "silver", "t")) == [("x", 2020), ("z", 2021)]
    with pytest.raises(ValueError, match="schema change"):
        io.write_layer(spark.createDataFrame([(1, 2021)], "K int, YEAR int"), base, "silver", "t",
                       allow_schema_change=False)


def test_preview_is_repeatable(spark):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("v")).repartition(7)
    assert [r.v for r in quality.preview(df, 3, "v").collect()] == [0, 1, 2]


def test_write_year_replaces_whole_years_only(spark):
    base = shared_path(spark, "t-year")
    schema = "K string, MARKET_NAME string, YEAR int"
    read = lambda: rows(io.read_layer(spark, base, "silver", "t", schema=spark.createDataFrame([], schema).schema), "K", "MARKET_NAME", "YEAR")
    io.write_year(spark.createDataFrame([("a", "02", 2020), ("b", "B", 2020), ("c", "B", 2021)], schema), base, "silver", "t", ("MARKET_NAME",))
    io.write_year(spark.createDataFrame([("d", "02", 2020)], schema), base, "silver", "t", ("MARKET_NAME",))
    assert read() == [("c", "B", 2021), ("d", "02", 2020)]
    io.write_year(spark.createDataFrame([], schema), base, "silver", "t", ("MARKET_NAME",), years=[2021])
    assert read() == [("d", "02", 2020)]
    with pytest.raises(ValueError, match="delivery"):
        io.write_year(spark.createDataFrame([("x", "B", 2019)], schema), base, "silver", "t", ("MARKET_NAME",), years=[2020])


def test_export_of_one_year_keeps_the_others_under_any_overwrite_mode(spark):
    path = shared_path(spark, "t-export")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for y in (2020, 2021):
            io.export_csv(spark.createDataFrame([(f"k{y}", y)], "K string, YEAR int"), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    assert rows(io.read_export(spark, path, spark.createDataFrame([], "K string, YEAR int").schema)) == [("k2020", 2020), ("k2021", 2021)]
