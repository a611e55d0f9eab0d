"""Table schemas, column lists and code domains.

Everything in the "fixed values" blocks must equal the values the curated
tables are defined with (market codes, state list, gold column orders); they
are stated here once and imported everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, DT, L = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.LongType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Expected column sets of the three silver inputs.
# ---------------------------------------------------------------------------
PATIENT_REF_COLUMNS = [
    "PATIENT_ID_REF", "PATIENT_BRTH_YR", "PATIENT_GENDER", "PAT_DX_AVAIL_FLAG", "ingestion_date",
]

PRODUCT_REF_COLUMNS = [
    "NDC_CD", "MKTED_PROD_NM", "MKTED_PROD_FORMLTN_NM", "ROUTE_ADM_NM",
    "DOSAGE_FORM_NM", "UNIFM_PROD_NM", "USC_CD", "ingestion_date",
]

CLAIMS_COLUMNS = [
    "MARKET_NAME", "PATIENT_ID", "CLAIM_ID", "RX_TYPE", "NDC", "CHNL_CD", "PROVIDER_ZIP",
    "PROVIDER_STATE", "PROVIDER_ST_CNTY_FIPS_CD", "PROVIDER_SPCL_CD", "DISPENSE_DATE",
    "MONTH_ID", "OPIOID_LA_SA_FLAG", "MARKET_NEW_FLAG", "QUANTITY", "DAYS_SUPPLY",
    "PATIENT_PAY", "IQVIA_PRESCRIBER_ID", "MODEL_TYP_CD", "NPI", "DAYS_SINCE_LAST_OPIOID",
    "YEAR", "ingestion_date",
]

# Silver types of the claims columns (bronze arrives as strings).
CLAIMS_TYPES: dict[str, T.DataType] = {
    "MARKET_NAME": S, "PATIENT_ID": S, "CLAIM_ID": S, "RX_TYPE": S, "NDC": S, "CHNL_CD": S,
    "PROVIDER_ZIP": S, "PROVIDER_STATE": S, "PROVIDER_ST_CNTY_FIPS_CD": S,
    "PROVIDER_SPCL_CD": S, "DISPENSE_DATE": DT, "MONTH_ID": S, "OPIOID_LA_SA_FLAG": S,
    "MARKET_NEW_FLAG": S, "QUANTITY": D, "DAYS_SUPPLY": I, "PATIENT_PAY": D,
    "IQVIA_PRESCRIBER_ID": S, "MODEL_TYP_CD": S, "NPI": S, "DAYS_SINCE_LAST_OPIOID": I,
    "YEAR": I, "ingestion_date": DT,
}

PATIENT_REF_SCHEMA = struct(
    ("PATIENT_ID_REF", S), ("PATIENT_BRTH_YR", I), ("PATIENT_GENDER", S),
    ("PAT_DX_AVAIL_FLAG", S), ("ingestion_date", DT),
)
PRODUCT_REF_SCHEMA = struct(*[(c, S) for c in PRODUCT_REF_COLUMNS[:-1]], ("ingestion_date", DT))
CLAIMS_SCHEMA = struct(*[(c, CLAIMS_TYPES[c]) for c in CLAIMS_COLUMNS])
# Deliveries that store every column as text; cleaning casts them.
CLAIMS_TEXT_SCHEMA = struct(*[(c, S) for c in CLAIMS_COLUMNS])

BENZO_DEF_SCHEMA = struct(("NDC", S), ("PROD_CUSTOM_LVL1_DESC", S))
OPIOID_DEF_SCHEMA = struct(("NDC", S), ("USC_CD", S), ("GPI_DESC", S))
MME_SCHEMA = struct(
    ("NDC", S), ("NDC_Numeric", L), ("PRODNME", S), ("GENNME", S), ("MASTER_FORM", S),
    ("CLASS", S), ("DRUG", S), ("LONGSHORTACTING", S), ("DEACLASSCODE", S),
    ("STRENGTH_PER_UNIT", D), ("UOM", S), ("MME_CONVERSION_FACTOR", D),
    ("MME_CONVERSION_FACTOR_N", S),
)
MANIFEST_RAW_SCHEMA = struct(("FileName", S), ("RecordCount(With Header Record)", S))
MANIFEST_SCHEMA = struct(("MARKET", S), ("DATA_TYPE", S), ("MONTH_ID", S), ("RECORD_COUNT", I))

# ---------------------------------------------------------------------------
# Code domains.
# ---------------------------------------------------------------------------
# Additional-markets file: market code -> gold table.
NON_OPIOID_MARKETS = {
    "A": "non_opioid_pain",
    "G": "gabapentin",
    "M": "muscle_relaxants",
    "P": "pregabalin",
    "S": "stimulants",
    "T": "naltrexone",
}
# Opioid file: raw codes O, B, N; derived codes B / OS (benzo split) and BU / O (opioid rule).
NALOXONE_CODE = "N"
BENZO_CODE = "B"
OPIOID_CODE = "O"
BENZO_MARKETS = {"B": "benzodiazepines", "OS": "other_sedatives"}
OPIOID_MARKETS = {"BU": "buprenorphine", "O": "opioid"}
BENZO_DESC_TO_CODE = {"BENZODIAZEPINES": "B", "OTHER": "OS"}
MOUD_USC_CD = "78340"
METHADONE_GPI_DESC = "Methadone HCl Conc 10 MG/ML"

# All eleven gold tables, in export order.
GOLD_MARKETS = [
    "opioid", "naloxone", "buprenorphine", "benzodiazepines", "other_sedatives", "gabapentin",
    "stimulants", "pregabalin", "muscle_relaxants", "naltrexone", "non_opioid_pain",
]

# Eligible provider states: 50 states + DC.
ELIGIBLE_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DC", "DE", "FL",
    "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME",
    "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH",
    "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI",
    "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI",
    "WY",
]
# Allowed values of the coded claims columns (MARKET_NAME: the raw market codes).
VALUE_DOMAINS = {
    "RX_TYPE": ["N", "R"],
    "MARKET_NAME": [*NON_OPIOID_MARKETS, BENZO_CODE, NALOXONE_CODE, OPIOID_CODE],
    "CHNL_CD": ["R"],
    "OPIOID_ER_LA_FLAG": ["L", "S"],
    "MARKET_NEW_FLAG": ["Y", "N"],
}
EXCLUDED_SPECIALTY = "VET"
# Label shown for a NULL specialty in reports (the original spelling is "Missng").
MISSING_LABEL = "Missing"

# Expected code widths.
NDC_WIDTH = 11
USC_WIDTH = 5
NPI_WIDTH = 10

# ---------------------------------------------------------------------------
# Gold column lists (UPDATE_DATE is appended by `stamp`).
# ---------------------------------------------------------------------------
_GOLD_HEAD = [
    "MARKET_NAME", "YEAR", "PATIENT_ID", "CLAIM_ID", "RX_TYPE", "NDC",
    "PROVIDER_ZIP", "PROVIDER_STATE", "PROVIDER_ST_CNTY_FIPS_CD",
    "PROVIDER_SPCL_CD", "DISPENSE_DATE", "MONTH_ID", "OPIOID_ER_LA_FLAG",
    "MARKET_NEW_FLAG", "QUANTITY", "DAYS_SUPPLY", "PATIENT_PAY",
    "IQVIA_PRESCRIBER_ID", "MODEL_TYP_CD", "NPI",
    "DAYS_SINCE_LAST_OPIOID", "PATIENT_BRTH_YR", "PATIENT_GENDER",
]
PRODUCT_COLUMNS = [
    "MKTED_PROD_NM", "MKTED_PROD_FORMLTN_NM", "ROUTE_ADM_NM", "DOSAGE_FORM_NM",
    "UNIFM_PROD_NM", "USC_CD",
]
MME_COLUMNS = [
    "PRODNME", "GENNME", "MASTER_FORM", "CLASS", "DRUG", "LONGSHORTACTING",
    "DEACLASSCODE", "STRENGTH_PER_UNIT", "UOM", "MME_CONVERSION_FACTOR",
    "MME_CONVERSION_FACTOR_N",
]
NON_OPIOID_GOLD_COLUMNS = _GOLD_HEAD + ["INGESTION_DATE"] + PRODUCT_COLUMNS  # 30
OPIOID_FILE_GOLD_COLUMNS = _GOLD_HEAD + ["PAT_DX_AVAIL_FLAG", "INGESTION_DATE"] + PRODUCT_COLUMNS  # 31
BUPRENORPHINE_GOLD_COLUMNS = (
    _GOLD_HEAD + ["PAT_DX_AVAIL_FLAG"] + PRODUCT_COLUMNS + MME_COLUMNS + ["INGESTION_DATE"]
)  # 42
OPIOID_GOLD_COLUMNS = (
    _GOLD_HEAD + ["PAT_DX_AVAIL_FLAG"] + PRODUCT_COLUMNS + MME_COLUMNS + ["MOUD", "INGESTION_DATE"]
)  # 43

# The columns of each gold table, and those of the one stored table that holds all of them.
GOLD_COLUMNS = {
    **{t: NON_OPIOID_GOLD_COLUMNS for t in NON_OPIOID_MARKETS.values()},
    **{t: OPIOID_FILE_GOLD_COLUMNS for t in ["naloxone", *BENZO_MARKETS.values()]},
    "buprenorphine": BUPRENORPHINE_GOLD_COLUMNS,
    "opioid": OPIOID_GOLD_COLUMNS,
}
GOLD_STORE_COLUMNS = [*OPIOID_GOLD_COLUMNS, "UPDATE_DATE"]
QUARANTINE_COLUMNS = ["CLAIM_ID", "YEAR", "PATIENT_ID", "NDC", "MARKET_NAME", "DISPENSE_DATE", "REASON"]

UPSERT_KEYS = ["CLAIM_ID", "YEAR"]
