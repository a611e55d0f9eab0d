"""Bronze -> silver steps for the two lookups and the claims table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.functions.codes import differs_or_null, in_or_null, normalize_code
from claimlake.operators.clean import align_variant, cast_types, exclude_value, keep_in
from claimlake.operators.colocate import Colocated, left_join
from claimlake.operators.relate import (
    DEFAULT_BROADCAST_MAX_ROWS,
    assert_unique,
    dedupe_latest,
    left_join_flag,
)

# Source names of the patient file -> canonical names.
PATIENT_RENAMES = {"PATIENT_ID": "PATIENT_ID_REF", "PAT_BRTH_YR": "PATIENT_BRTH_YR", "PAT_GENDER_CD": "PATIENT_GENDER"}
CLAIMS_CASTS = {
    "DISPENSE_DATE": "date", "QUANTITY": "double", "DAYS_SUPPLY": "int",
    "PATIENT_PAY": "double", "DAYS_SINCE_LAST_OPIOID": "int",
}


def patient_lookup(bronze: DataFrame) -> DataFrame:
    """Canonical patient lookup: renamed columns; the flag column that only
    one delivery variant has is added as a blank to the other."""
    df = bronze.withColumnsRenamed({k: v for k, v in PATIENT_RENAMES.items() if k in bronze.columns})
    return align_variant(df, {"PAT_DX_AVAIL_FLAG": (" ", "string"), "ingestion_date": (None, "date")})


def product_lookup(bronze: DataFrame, width: int = schemas.NDC_WIDTH) -> DataFrame:
    """Product lookup with repaired NDC_CD and one row per code (the latest
    delivery wins, see :func:`dedupe_latest`)."""
    df = cast_types(bronze.withColumn("NDC_CD", normalize_code("NDC_CD", width)), {"ingestion_date": "date"})
    df = align_variant(df, {c: (None, "string") for c in schemas.PRODUCT_REF_COLUMNS if c != "ingestion_date"})
    df = align_variant(df, {"ingestion_date": (None, "date")}).select(*schemas.PRODUCT_REF_COLUMNS)
    return dedupe_latest(df, ["NDC_CD"], "ingestion_date")


def claims_enrich(
    claims: DataFrame | Colocated,
    patients: DataFrame | Colocated,
    products: DataFrame,
    normalize_before_join: bool = True,
    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
    on_duplicate: str = "keep",
) -> DataFrame:
    """claims LEFT JOIN patients LEFT JOIN products with merge indicators
    ``merged_pat_ref`` / ``merged_prod_ref``; the lookups' ingestion dates are
    dropped. ``normalize_before_join`` repairs claim NDCs first so that short
    and 12-character codes can match (False joins on the raw code).
    A lookup that carries YEAR is joined within the year: a claim meets the
    lookup of its own delivery, however many years are stored.
    ``on_duplicate`` guards against lookups that repeat a key (a repeated key
    would multiply claims). Claims and patients stored by the same buckets
    (both, see :mod:`claimlake.operators.colocate`) are joined without moving either."""
    def lookup(df: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
        also = ["YEAR"] if "YEAR" in df.columns else []
        return assert_unique(df, [key, *also], on_duplicate, "ingestion_date").drop("ingestion_date"), also

    prods, prod_also = lookup(products, "NDC_CD")
    if isinstance(claims, Colocated):
        j = left_join(claims, patients, "merged_pat_ref", broadcast_max_rows)
    else:
        pats, pat_also = lookup(patients, "PATIENT_ID_REF")
        j = left_join_flag(claims, pats, "PATIENT_ID", "PATIENT_ID_REF", flag="merged_pat_ref",
                           broadcast_max_rows=broadcast_max_rows, salt_from=["CLAIM_ID"], also=pat_also)
    if normalize_before_join:
        j = j.withColumn("NDC", normalize_code("NDC"))
    return left_join_flag(j, prods, "NDC", "NDC_CD", flag="merged_prod_ref",
                          broadcast_max_rows=broadcast_max_rows, salt_from=["CLAIM_ID"], also=prod_also)


def left_out(states: list[str] = schemas.ELIGIBLE_STATES, excluded_specialty: str = schemas.EXCLUDED_SPECIALTY) -> Column:
    """The claims that :func:`claims_clean` drops; never NULL."""
    kept = differs_or_null("PROVIDER_SPCL_CD", excluded_specialty) & in_or_null("PROVIDER_STATE", states)
    return ~F.coalesce(kept, F.lit(False))


def claims_clean(
    enriched: DataFrame,
    states: list[str] = schemas.ELIGIBLE_STATES,
    excluded_specialty: str = schemas.EXCLUDED_SPECIALTY,
    ndc_fallback_to_lookup: bool = False,
) -> DataFrame:
    """Typed, filtered silver claims.

    Casts (malformed -> NULL), OPIOID_LA_SA_FLAG -> OPIOID_ER_LA_FLAG, drops
    the excluded specialty but keeps NULL specialties, keeps eligible or NULL
    states and repairs NDC. ``ndc_fallback_to_lookup=True`` reproduces the
    variant where a code that needs no repair is replaced by the joined
    lookup code (NULL when unmatched).
    """
    df = cast_types(enriched, CLAIMS_CASTS)
    if "OPIOID_LA_SA_FLAG" in df.columns:
        df = df.withColumnRenamed("OPIOID_LA_SA_FLAG", "OPIOID_ER_LA_FLAG")
    df = exclude_value(df, "PROVIDER_SPCL_CD", excluded_specialty, keep_null=True)
    df = keep_in(df, "PROVIDER_STATE", states, keep_null=True)
    fallback = F.col("NDC_CD") if ndc_fallback_to_lookup else None
    return df.withColumn("NDC", normalize_code("NDC", schemas.NDC_WIDTH, fallback))


def claims_silver(claims: DataFrame, patients: DataFrame, products: DataFrame, **kw) -> DataFrame:
    """:func:`claims_enrich` then :func:`claims_clean` (keyword arguments go
    to whichever step takes them)."""
    enrich_kw = {k: kw.pop(k) for k in ("normalize_before_join", "broadcast_max_rows", "on_duplicate") if k in kw}
    return claims_clean(claims_enrich(claims, patients, products, **enrich_kw), **kw)
