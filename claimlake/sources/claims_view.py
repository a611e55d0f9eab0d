"""Claims-shaped inputs derived from the driver's TPC-H-style tables.

These are the seven views the tests and queries run on (claims, patient_ref,
product_ref, benzo_def, opioid_def, mme, manifest_raw). They are written with
the DataFrame API; each has an equivalent SQL statement in
``claimlake.plans.oracle`` and a test checks that both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake import schemas


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One driver table (Parquet); ``columns`` prunes the scan.

    The driver's tables are read-only, so the schema inferred on the first
    read of a path is reused (later reads skip the footer-reading job)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    _SCHEMAS.setdefault(path, df.schema)
    return df.select(*columns) if columns else df


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad11(c: Column) -> Column:
    return F.lpad(_s(c), 11, "0")


def _case(key: Column, mapping: Sequence[tuple[int, str | None]], default: str | None) -> Column:
    out = None
    for k, v in mapping:
        out = (F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v)))
    return out.otherwise(F.lit(default))


# Fixed values of the fixture views (market by part key, state by nation key).
MARKET_BY_PART_MOD10 = [(0, "O"), (1, "O"), (2, "B"), (3, "N"), (4, "A"),
                        (5, "G"), (6, "M"), (7, "P"), (8, "S"), (9, "T")]
STATE_BY_NATION_MOD8 = [(0, "AL"), (1, "CA"), (2, "NY"), (3, "TX"), (4, "PR"), (5, "GU"), (6, "WY"), (7, None)]


def claims(spark: SparkSession, sf_dir: str, orders_first: bool = False) -> DataFrame:
    """One claim per line item, with patient = customer and NDC from the part key.
    ``orders_first`` joins orders and customers first, so that line items move once
    at most where customers are too many to be broadcast."""
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    if orders_first:
        j = li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
    else:
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    ship = F.col("l_shipdate")
    return j.select(
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("CLAIM_ID"),
        _s(F.col("o_custkey")).alias("PATIENT_ID"),
        F.when(pk % 7 == 0, F.concat(F.lit("9"), _pad11(pk)))
        .when(pk % 5 == 0, _s(pk))
        .otherwise(_pad11(pk)).alias("NDC"),
        _case(pk % 10, MARKET_BY_PART_MOD10, None).alias("MARKET_NAME"),
        F.when(sk % 11 == 0, F.lit("VET"))
        .when(sk % 11 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("S"), _s(sk % 11))).alias("PROVIDER_SPCL_CD"),
        _case(F.col("c_nationkey") % 8, STATE_BY_NATION_MOD8, None).alias("PROVIDER_STATE"),
        F.when(F.col("l_linestatus") == "O", F.lit("N")).otherwise(F.lit("R")).alias("RX_TYPE"),
        ship.cast("date").alias("DISPENSE_DATE"),
        (F.year(ship) * 100 + F.month(ship)).cast("int").alias("MONTH_ID"),
        F.year(ship).cast("int").alias("YEAR"),
        F.col("l_quantity").alias("QUANTITY"),
        (F.col("l_linenumber") * 10).alias("DAYS_SUPPLY"),
        (F.col("l_extendedprice") * F.col("l_discount") - 100).alias("PATIENT_PAY"),
        _s(sk).alias("NPI"),
    )


def patient_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    k = F.col("c_custkey")
    return c.where(k % 20 != 0).select(
        _s(k).alias("PATIENT_ID_REF"),
        F.when(k % 13 == 0, F.lit(None).cast("int")).otherwise((1930 + k % 80).cast("int")).alias("PATIENT_BRTH_YR"),
        _case(k % 3, [(0, "F"), (1, "M")], "U").alias("PATIENT_GENDER"),
        F.lit(" ").alias("PAT_DX_AVAIL_FLAG"),
    )


def product_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lookup; a sixth of the codes arrive twice (two ingestion dates)."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    k = F.col("p_partkey")
    # Two deliveries: every code in the first, codes divisible by 6 again in the second.
    deliveries = F.explode(F.when(k % 6 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    p = p.where(k % 25 != 0).withColumn("k", deliveries)
    return p.select(
        F.when(k % 7 == 0, F.concat(F.lit("9"), _pad11(k)))
        .when(k % 3 == 0, _s(k))
        .otherwise(_pad11(k)).alias("NDC_CD"),
        F.col("p_name").alias("MKTED_PROD_NM"),
        F.col("p_brand").alias("UNIFM_PROD_NM"),
        F.col("p_type").alias("ROUTE_ADM_NM"),
        _s(F.col("p_size")).alias("DOSAGE_FORM_NM"),
        F.when(k % 4 == 0, F.lit("78340")).when(k % 17 == 0, F.lit("123")).otherwise(F.lit("02200")).alias("USC_CD"),
        F.concat(_s(2015 + F.col("k")), F.lit("-01-01")).alias("ingestion_date"),
    )


def benzo_def(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey"])
    k = F.col("p_partkey")
    return p.where(k % 10 == 2).select(
        _pad11(k).alias("NDC"),
        _case(k % 30, [(2, "BENZODIAZEPINES"), (12, "OTHER")], "UNSPECIFIED").alias("PROD_CUSTOM_LVL1_DESC"),
    )


def opioid_def(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey"])
    k = F.col("p_partkey")
    return p.where((k % 10).isin(0, 1) & (k % 50 != 1)).select(
        _pad11(k).alias("NDC"),
        F.when(k % 4 != 0, F.lit("02200")).otherwise(F.lit("78340")).alias("USC_CD"),
        F.when(k % 60 == 0, F.lit(None).cast("string"))
        .when(k % 40 == 0, F.lit(schemas.METHADONE_GPI_DESC))
        .otherwise(F.lit("Buprenorphine")).alias("GPI_DESC"),
    )


def mme(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    k = F.col("p_partkey")
    return p.where((k % 10).isin(0, 1) & (k % 9 != 0)).select(
        _pad11(k).alias("NDC"),
        k.alias("NDC_Numeric"),
        F.col("p_name").alias("PRODNME"),
        F.col("p_brand").alias("GENNME"),
        F.col("p_type").alias("MASTER_FORM"),
        F.lit("Opioid").alias("CLASS"),
        F.col("p_type").alias("DRUG"),
        F.when(k % 2 == 0, F.lit("LA")).otherwise(F.lit("SA")).alias("LONGSHORTACTING"),
        F.lit("2").alias("DEACLASSCODE"),
        F.col("p_size").cast("double").alias("STRENGTH_PER_UNIT"),
        F.lit("MG").alias("UOM"),
        F.lit(1.5).cast("double").alias("MME_CONVERSION_FACTOR"),
        F.lit("1.5").alias("MME_CONVERSION_FACTOR_N"),
    )


def _with_thousands(n: Column) -> Column:
    return F.when(
        n >= 1000,
        F.concat(_s(F.floor(n / 1000).cast("int")), F.lit(","), F.lpad(_s(n % 1000), 3, "0")),
    ).otherwise(_s(n))


def manifest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery manifest as the vendor ships it: file name + record count with
    thousands commas (header line included). Month 199603 is absent, 200201
    exists only here, every seventh month and the product count disagree."""
    cl = claims(spark, sf_dir)
    month = F.col("MONTH_ID")
    factrx = (
        cl.where(month != 199603)
        .groupBy("MONTH_ID")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.concat(F.lit("OPI_FactRx_"), _s(month), F.lit(".txt")).alias("FileName"),
            (F.col("n") + 1 + F.when(month % 7 == 0, F.lit(3)).otherwise(F.lit(0))).alias("n"),
        )
    )
    extra = spark.createDataFrame([("OPI_FactRx_200201.txt", 1)], "FileName string, n long")
    pats = patient_ref(spark, sf_dir).agg((F.count(F.lit(1)) + 1).alias("n")).select(
        F.lit("OPI_Patient.txt").alias("FileName"), "n")
    prods = product_ref(spark, sf_dir).agg((F.count(F.lit(1)) + 2).alias("n")).select(
        F.lit("OPI_Product.txt").alias("FileName"), "n")
    m = factrx.unionByName(extra).unionByName(pats).unionByName(prods)
    return m.select("FileName", _with_thousands(F.col("n")).alias("RECORD_COUNT_RAW"))


VIEWS = {
    "claims": claims,
    "patient_ref": patient_ref,
    "product_ref": product_ref,
    "benzo_def": benzo_def,
    "opioid_def": opioid_def,
    "mme": mme,
    "manifest_raw": manifest_raw,
}


def claims_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims view widened to the full expected bronze column set
    (columns the view lacks arrive as typed NULLs)."""
    df = claims(spark, sf_dir)
    add = {c: F.lit(None).cast(schemas.CLAIMS_TYPES[c]) for c in schemas.CLAIMS_COLUMNS if c not in df.columns}
    df = df.withColumns(add).withColumn("MONTH_ID", F.col("MONTH_ID").cast("string"))
    return df.select(*schemas.CLAIMS_COLUMNS)


def claims_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims as a delivery of text: every column a string, flags filled,
    some cells malformed, some claims without an id or with an unmapped market."""
    df = claims(spark, sf_dir)
    d, day = F.col("DAYS_SUPPLY"), F.col("DISPENSE_DATE").cast("string")
    changed = {
        "CLAIM_ID": F.when((d != 70) | (F.col("RX_TYPE") != "R"), F.col("CLAIM_ID")),
        "MARKET_NAME": F.when(d == 50, F.lit("Z")).otherwise(F.col("MARKET_NAME")),
        "CHNL_CD": F.when(d <= 40, F.lit("R")).when(d == 60, F.lit("M")),
        "OPIOID_LA_SA_FLAG": F.when(d == 10, F.lit("L")).when(d == 20, F.lit("S")).when(d == 30, F.lit("LA")),
        "MARKET_NEW_FLAG": F.when(F.col("RX_TYPE") == "N", F.lit("Y")).otherwise(F.lit("N")),
        "DISPENSE_DATE": F.when((d == 30) & (F.col("RX_TYPE") == "N"), F.lit("1995-13-45")).otherwise(day),
        "QUANTITY": F.when((d == 20) & (F.col("QUANTITY") > 45), F.lit("n/a")).otherwise(F.col("QUANTITY").cast("int").cast("string")),
        "PATIENT_PAY": F.when((d == 40) & (F.col("QUANTITY") > 40), F.lit("12..5")).otherwise(F.floor("PATIENT_PAY").cast("string")),
        "DAYS_SINCE_LAST_OPIOID": F.when(d == 10, F.lit("unknown")).when(d == 20, F.lit("14")),
    }
    df = df.select(*[changed.get(c, F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in schemas.CLAIMS_COLUMNS])
    return df
