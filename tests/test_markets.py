from claimlake.operators import markets
from tests.conftest import rows


def test_opioid_rule_cases(spark):
    d = spark.createDataFrame([
        ("1", "78340", "Methadone HCl Conc 10 MG/ML"), ("2", "78340", "Buprenorphine"), ("3", "78340", None),
        ("4", "02200", "Buprenorphine"), ("5", None, "Buprenorphine")], "NDC string, USC_CD string, GPI_DESC string")
    out = rows(markets.opioid_rule(d), "NDC", "MARKET_NAME", "MOUD")
    assert out == [("1", "O", 1), ("2", "BU", 1), ("3", "O", 1), ("4", "O", 0), ("5", "O", 0)]


def test_benzo_flag(spark):
    d = spark.createDataFrame([("1", "BENZODIAZEPINES"), ("2", "OTHER"), ("3", "UNSPECIFIED"), ("4", None)],
                              "NDC string, PROD_CUSTOM_LVL1_DESC string")
    assert rows(markets.benzo_flag(d), "NDC", "BENZO_FLAG") == [("1", "B"), ("2", "OS"), ("3", None), ("4", None)]
