"""The registered queries: one per operator/job of the inventory.

``QUERIES[name] = (spark_fn, oracle_sql)``; ``spark_fn(spark, sf_dir)``
returns a DataFrame built with the library, ``oracle_sql`` is independent
DuckDB SQL over the driver's tables giving the same rows (column names
equal, computed columns aliased on both sides).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.functions.codes import normalize_code, null_label
from claimlake.operators import clean, colocate, curate, markets, profiles, quality, reconcile, relate, stats
from claimlake.operators.store import merge_into, read_store
from claimlake.operators.upsert import CODEC, upsert
from claimlake.plans.oracle import RUN_DATE, STATES, norm, with_views
from claimlake.session import materialize, shared_path, sparing_disk
from claimlake.sources import claims_view as cv
from claimlake.sources import io

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}

ALL_MARKET_CODES = sorted(list(schemas.NON_OPIOID_MARKETS) + ["B", "N", "O"])


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- helpers
def _patients(spark, sf):
    return curate.patient_lookup(cv.patient_ref(spark, sf))


def _products(spark, sf):
    return curate.product_lookup(cv.product_ref(spark, sf))


def _silver(spark, sf):
    return curate.claims_silver(cv.claims_bronze(spark, sf), _patients(spark, sf), _products(spark, sf))


def _gold_input(spark, sf):
    return markets.gold_input(_silver(spark, sf))


def _manifest(spark, sf):
    return io.parse_manifest(cv.manifest_raw(spark, sf), count_col="RECORD_COUNT_RAW")


def _case_sql(col: str, mapping: dict[str, str]) -> str:
    return "case " + " ".join(f"when {col} = '{k}' then '{v}'" for k, v in mapping.items()) + " end"


def _gold_cols_sql(cols: list[str]) -> str:
    src = {"INGESTION_DATE": "ingestion_date"}
    return ", ".join(f"{src.get(c, c)} as {c}" for c in cols)


PARSE_MANIFEST_SQL = """
select lower(split_part(FileName, '_', 1)) as MARKET,
       case when len(string_split(FileName, '_')) >= 2 then lower(split_part(split_part(FileName, '_', 2), '.', 1)) end as DATA_TYPE,
       case when len(string_split(FileName, '_')) >= 3 then split_part(split_part(FileName, '_', 3), '.', 1) end as MONTH_ID,
       try_cast(replace(RECORD_COUNT_RAW, ',', '') as integer) as RECORD_COUNT
from manifest_raw"""


# ---------------------------------------------------------------- entry
ENTRY_SQL = with_views(f"""
select MARKET_NAME, merged_pat_ref, merged_prod_ref, count(*) as n_claims,
       round(sum(QUANTITY), 2) as total_quantity
from silver group by MARKET_NAME, merged_pat_ref, merged_prod_ref""", "silver")


@register("q_entry_eligible_by_market", ENTRY_SQL)
def q_entry_eligible_by_market(spark, sf):
    """Eligible claims (no VET, eligible or unknown state) by market and lookup match status."""
    s = _silver(spark, sf)
    return s.groupBy("MARKET_NAME", "merged_pat_ref", "merged_prod_ref").agg(
        F.count(F.lit(1)).alias("n_claims"), F.round(F.sum("QUANTITY"), 2).alias("total_quantity"))


# ---------------------------------------------------------------- manifest & checks
@register("q_parse_manifest", with_views(PARSE_MANIFEST_SQL, "manifest_raw"))
def q_parse_manifest(spark, sf):
    return _manifest(spark, sf)


# the types of the claims view
_VIEW_TYPES = {"DISPENSE_DATE": "date", "MONTH_ID": "int", "YEAR": "int", "QUANTITY": "double", "DAYS_SUPPLY": "int", "PATIENT_PAY": "double"} | {
    c: "string" for c in ("CLAIM_ID", "PATIENT_ID", "NDC", "MARKET_NAME", "PROVIDER_SPCL_CD", "PROVIDER_STATE", "RX_TYPE", "NPI")}
_EXPECTED_TYPES = {c: schemas.CLAIMS_TYPES[c].simpleString() for c in schemas.CLAIMS_COLUMNS}


def _schema_status(c: str) -> tuple[str | None, str | None, str]:
    want, have = _EXPECTED_TYPES.get(c), _VIEW_TYPES.get(c)
    return want, have, "missing" if have is None else "extra" if want is None else "ok" if want == have else "retyped"


def _quoted(x: str | None) -> str:
    return "cast(null as varchar)" if x is None else f"'{x}'"


_SCHEMA_CHECK_SQL = with_views(" union all ".join(
    f"""select (select count(*) from claims) as "rows", '{c}' as "column", {_quoted(want)} as expected_type, {_quoted(have)} as actual_type,
    '{status}' as status, {f"(select count({c}) from claims)" if have else "cast(0 as bigint)"} as filled"""
    for c in _EXPECTED_TYPES | _VIEW_TYPES for want, have, status in [_schema_status(c)]), "claims")


@register("q_schema_diff", _SCHEMA_CHECK_SQL)
def q_schema_diff(spark, sf):
    """Expected and delivered claims columns with types, status and filled values, counted from the table."""
    return quality.schema_check(cv.claims(spark, sf), _EXPECTED_TYPES)


_ROW_COUNT_SQL = with_views(f"""
, m as ({PARSE_MANIFEST_SQL}),
checks as (
  select 'patient' as DATA_TYPE, (select count(*) from patient_ref) + 1 as ACTUAL_COUNT
  union all select 'product', (select count(*) from product_ref) + 1
)
select c.DATA_TYPE, cast((select min(RECORD_COUNT) from m where m.DATA_TYPE = c.DATA_TYPE) as bigint) as EXPECTED_COUNT,
       cast(c.ACTUAL_COUNT as bigint) as ACTUAL_COUNT,
       case when (select count(*) from m where m.DATA_TYPE = c.DATA_TYPE) = 0 then 'no_expected'
            when (select count(*) from m where m.DATA_TYPE = c.DATA_TYPE) > 1 then 'ambiguous'
            when (select min(RECORD_COUNT) from m where m.DATA_TYPE = c.DATA_TYPE) = c.ACTUAL_COUNT then 'match'
            else 'mismatch' end as STATUS
from checks c""", "manifest_raw")


@register("q_row_count_check", _ROW_COUNT_SQL)
def q_row_count_check(spark, sf):
    m = _manifest(spark, sf)
    pat = quality.row_count_check(cv.patient_ref(spark, sf), m, "patient")
    prod = quality.row_count_check(cv.product_ref(spark, sf), m, "product")
    return pat.unionByName(prod)


_RECONCILE_SQL = with_views(f"""
, m as ({PARSE_MANIFEST_SQL}),
a as (select cast(MONTH_ID as varchar) as MONTH_ID, count(*) as ACTUAL_COUNT from claims group by 1),
e as (select MONTH_ID, cast(RECORD_COUNT as bigint) - 1 as EXPECTED_COUNT from m where DATA_TYPE = 'factrx')
select coalesce(a.MONTH_ID, e.MONTH_ID) as MONTH_ID, a.ACTUAL_COUNT, e.EXPECTED_COUNT,
       a.ACTUAL_COUNT - e.EXPECTED_COUNT as DIFF,
       case when e.EXPECTED_COUNT is null and a.ACTUAL_COUNT is not null then 'only_actual'
            when a.ACTUAL_COUNT is null then 'only_expected'
            when a.ACTUAL_COUNT = e.EXPECTED_COUNT then 'match' else 'mismatch' end as STATUS
from a full join e on a.MONTH_ID = e.MONTH_ID""", "manifest_raw")


@register("q_reconcile_months", _RECONCILE_SQL)
def q_reconcile_months(spark, sf):
    return quality.reconcile_months(cv.claims(spark, sf), _manifest(spark, sf), how="full")


_ODD_MARKETS_SQL = "case when DAYS_SUPPLY = 60 then 'Z' when DAYS_SUPPLY <> 50 then MARKET_NAME end"
_PIVOT_SQL = with_views("select YEAR, MONTH_ID, " + ", ".join(
    f"nullif(count(*) filter (where M = '{m}'), 0) as {m}" for m in ALL_MARKET_CODES
) + f""", nullif(count(*) filter (where M not in ({", ".join(f"'{m}'" for m in ALL_MARKET_CODES)})), 0) as "OTHER",
    nullif(count(*) filter (where M is null), 0) as "NULL_VALUE"
  from (select *, {_ODD_MARKETS_SQL} as M from claims) group by YEAR, MONTH_ID""", "claims")


@register("q_pivot_market_month", _PIVOT_SQL)
def q_pivot_market_month(spark, sf):
    """Claims by month and market; some claims are given an unmapped code or none."""
    claims = cv.claims(spark, sf)
    odd = F.when(F.col("DAYS_SUPPLY") == 60, F.lit("Z")).when(F.col("DAYS_SUPPLY") != 50, F.col("MARKET_NAME"))
    return quality.pivot_counts(claims.withColumn("MARKET_NAME", odd), ["YEAR", "MONTH_ID"], "MARKET_NAME", ALL_MARKET_CODES)


_MISSING_SQL = with_views("select " + ", ".join(
    f"count(*) - count({c}) as {c}" for c in schemas.CLAIMS_COLUMNS) + " from claims_bronze", "claims_bronze")


@register("q_missing_counts", _MISSING_SQL)
def q_missing_counts(spark, sf):
    return quality.missing_counts(cv.claims_bronze(spark, sf))


_KEY_PROFILE_SQL = with_views("""
select count(*) as "rows", count(distinct PATIENT_ID) as distinct_keys,
       count(*) - count(PATIENT_ID) as null_keys,
       count(distinct PATIENT_ID) + case when count(*) - count(PATIENT_ID) > 0 then 1 else 0 end as distinct_with_null
from claims""", "claims")


@register("q_key_profile", _KEY_PROFILE_SQL)
def q_key_profile(spark, sf):
    return quality.key_profile(cv.claims(spark, sf), "PATIENT_ID")


@register("q_freq_route", with_views(
    "select ROUTE_ADM_NM, count(*) as count from product_silver group by ROUTE_ADM_NM", "product_silver"))
def q_freq_route(spark, sf):
    return quality.frequency(_products(spark, sf), "ROUTE_ADM_NM", order="count_desc")


@register("q_freq_birth_year", with_views(
    "select PATIENT_BRTH_YR, count(*) as count from patient_ref group by PATIENT_BRTH_YR", "patient_ref"))
def q_freq_birth_year(spark, sf):
    """Patient lookup: rows per birth year (NULL years as their own row)."""
    return quality.frequency(_patients(spark, sf), "PATIENT_BRTH_YR")


@register("q_freq_gender", with_views(
    "select PATIENT_GENDER, count(*) as count from patient_ref group by PATIENT_GENDER", "patient_ref"))
def q_freq_gender(spark, sf):
    return quality.frequency(_patients(spark, sf), "PATIENT_GENDER")


_FREQ_STATE_SQL = with_views(f"""
select PROVIDER_STATE, count(*) as count from claims
where PROVIDER_SPCL_CD is distinct from 'VET' and PROVIDER_STATE not in ({STATES})
group by PROVIDER_STATE""", "claims")


@register("q_freq_state_desc", _FREQ_STATE_SQL)
def q_freq_state_desc(spark, sf):
    """Ineligible states (non-NULL, not in the list) after the VET filter, most frequent first."""
    novet = clean.exclude_value(cv.claims(spark, sf), "PROVIDER_SPCL_CD", schemas.EXCLUDED_SPECIALTY)
    return quality.frequency(clean.outside(novet, "PROVIDER_STATE", schemas.ELIGIBLE_STATES),
                             "PROVIDER_STATE", order="count_desc")


# ---------------------------------------------------------------- scalar & cleaning
_CAST_SQL = with_views("""
select CLAIM_ID, YEAR,
       try_cast(cast(DISPENSE_DATE as varchar) as date) as DISPENSE_DATE,
       try_cast(cast(QUANTITY as varchar) as double) as QUANTITY,
       try_cast(cast(DAYS_SUPPLY as varchar) as integer) as DAYS_SUPPLY,
       try_cast(cast(PATIENT_PAY as varchar) as double) as PATIENT_PAY,
       try_cast(NDC as integer) as NDC_AS_INT
from claims""", "claims")


@register("q_cast_types", _CAST_SQL)
def q_cast_types(spark, sf):
    """Bronze arrives as strings: string columns cast to their silver types,
    malformed values (12-digit codes overflow an int) become NULL."""
    c = cv.claims(spark, sf)
    as_text = c.select("CLAIM_ID", "YEAR", *[F.col(x).cast("string").alias(x) for x in
                                              ("DISPENSE_DATE", "QUANTITY", "DAYS_SUPPLY", "PATIENT_PAY")],
                       F.col("NDC").alias("NDC_AS_INT"))
    return clean.cast_types(as_text, {"DISPENSE_DATE": "date", "QUANTITY": "double", "DAYS_SUPPLY": "int",
                                      "PATIENT_PAY": "double", "NDC_AS_INT": "int"})


@register("q_normalize_code", with_views(
    f"select CLAIM_ID, YEAR, NDC as NDC_RAW, {norm('NDC')} as NDC from claims", "claims"))
def q_normalize_code(spark, sf):
    c = cv.claims(spark, sf)
    return c.select("CLAIM_ID", "YEAR", F.col("NDC").alias("NDC_RAW"), normalize_code("NDC").alias("NDC"))


_INVALID_LEN_SQL = with_views(f"""
select 'claims' as table_name, 'NDC' as column_name, 'raw' as stage, count(*) filter (where length(NDC) <> 11) as invalid from claims
union all select 'claims', 'NDC', 'repaired', count(*) filter (where length({norm('NDC')}) <> 11) from claims
union all select 'claims', 'NPI', 'raw', count(*) filter (where length(NPI) <> 10) from claims
union all select 'product_ref', 'NDC_CD', 'raw', count(*) filter (where length(NDC_CD) <> 11) from product_ref
union all select 'product_ref', 'USC_CD', 'raw', count(*) filter (where length(USC_CD) <> 5) from product_ref
union all select 'product_ref', 'NDC_CD', 'repaired', count(*) filter (where length({norm('NDC_CD')}) <> 11) from product_ref
""", "claims", "product_ref")


@register("q_invalid_length", _INVALID_LEN_SQL)
def q_invalid_length(spark, sf):
    def long(df, table, stage, widths):
        wide = quality.length_violations(df, widths)
        return wide.unpivot([], list(widths), "column_name", "invalid").select(
            F.lit(table).alias("table_name"), "column_name", F.lit(stage).alias("stage"), "invalid")
    c, p = cv.claims(spark, sf), cv.product_ref(spark, sf)
    return (long(c, "claims", "raw", {"NDC": 11, "NPI": 10})
            .unionByName(long(c.withColumn("NDC", normalize_code("NDC")), "claims", "repaired", {"NDC": 11}))
            .unionByName(long(p, "product_ref", "raw", {"NDC_CD": 11, "USC_CD": 5}))
            .unionByName(long(p.withColumn("NDC_CD", normalize_code("NDC_CD")), "product_ref", "repaired",
                              {"NDC_CD": 11})))


@register("q_dedupe_latest", with_views("select * from product_silver", "product_silver"))
def q_dedupe_latest(spark, sf):
    """Product lookup: one row per repaired NDC, latest delivery first."""
    return _products(spark, sf)


_DEDUPE_CLAIMS_SQL = with_views("""
select * exclude (rn) from (
  select *, row_number() over (partition by CLAIM_ID, YEAR order by DISPENSE_DATE desc nulls last,
      PATIENT_ID desc nulls last, NDC desc nulls last, MARKET_NAME desc nulls last, PROVIDER_SPCL_CD desc nulls last,
      PROVIDER_STATE desc nulls last, RX_TYPE desc nulls last, MONTH_ID desc nulls last, QUANTITY desc nulls last,
      DAYS_SUPPLY desc nulls last, PATIENT_PAY desc nulls last, NPI desc nulls last) as rn
  from claims) where rn = 1""", "claims")


@register("q_dedupe_claims", _DEDUPE_CLAIMS_SQL)
def q_dedupe_claims(spark, sf):
    """Repeated (CLAIM_ID, YEAR) keys resolved to the latest dispense."""
    return relate.dedupe_latest(cv.claims(spark, sf), ["CLAIM_ID", "YEAR"], "DISPENSE_DATE")


# ---------------------------------------------------------------- joins
_LEFT_PAT_SQL = with_views("""
select c.CLAIM_ID, c.YEAR, c.PATIENT_ID, p.PATIENT_ID_REF, p.PATIENT_BRTH_YR, p.PATIENT_GENDER,
       case when p.PATIENT_ID_REF is not null then 1 else 0 end as merged_pat_ref
from claims c left join patient_ref p on c.PATIENT_ID = p.PATIENT_ID_REF""", "claims", "patient_ref")


@register("q_left_patient", _LEFT_PAT_SQL)
def q_left_patient(spark, sf):
    j = relate.left_join_flag(cv.claims(spark, sf), _patients(spark, sf), "PATIENT_ID", "PATIENT_ID_REF",
                              flag="merged_pat_ref", salt_from=["CLAIM_ID"])
    return j.select("CLAIM_ID", "YEAR", "PATIENT_ID", "PATIENT_ID_REF", "PATIENT_BRTH_YR", "PATIENT_GENDER",
                    "merged_pat_ref")


@register("q_left_patient_colocated", _LEFT_PAT_SQL)
def q_left_patient_colocated(spark, sf):
    """The patient join of tables stored by patient in the same buckets: neither side moves."""
    base, buckets = shared_path(spark, "q_colocated"), 8
    claims = colocate.store(cv.claims(spark, sf), f"{base}/claims", ["PATIENT_ID"], buckets)
    patients = colocate.store(_patients(spark, sf).drop("ingestion_date"), f"{base}/patients", ["PATIENT_ID_REF"], claims.buckets, lookup=True)
    j = colocate.left_join(claims, patients, "merged_pat_ref")
    return j.select("CLAIM_ID", "YEAR", "PATIENT_ID", "PATIENT_ID_REF", "PATIENT_BRTH_YR", "PATIENT_GENDER", "merged_pat_ref")


_LEFT_PROD_SQL = with_views(f"""
select c.CLAIM_ID, c.YEAR, {norm('c.NDC')} as NDC, d.NDC_CD, d.USC_CD, d.ROUTE_ADM_NM,
       case when d.NDC_CD is not null then 1 else 0 end as merged_prod_ref
from claims c left join product_silver d on {norm('c.NDC')} = d.NDC_CD""", "claims", "product_silver")


@register("q_left_product", _LEFT_PROD_SQL)
def q_left_product(spark, sf):
    c = cv.claims(spark, sf).withColumn("NDC", normalize_code("NDC"))
    j = relate.left_join_flag(c, _products(spark, sf), "NDC", "NDC_CD", flag="merged_prod_ref",
                              salt_from=["CLAIM_ID"])
    return j.select("CLAIM_ID", "YEAR", "NDC", "NDC_CD", "USC_CD", "ROUTE_ADM_NM", "merged_prod_ref")


_LEFT_PROD_RAW_SQL = with_views("""
select c.CLAIM_ID, c.YEAR, c.NDC, d.NDC_CD,
       case when d.NDC_CD is not null then 1 else 0 end as merged_prod_ref
from claims c left join product_silver d on c.NDC = d.NDC_CD""", "claims", "product_silver")


@register("q_left_product_raw_ndc", _LEFT_PROD_RAW_SQL)
def q_left_product_raw_ndc(spark, sf):
    """The join on the unrepaired claim code (repair after the join): short
    and 12-character codes find no product."""
    j = relate.left_join_flag(cv.claims(spark, sf), _products(spark, sf), "NDC", "NDC_CD", flag="merged_prod_ref")
    return j.select("CLAIM_ID", "YEAR", "NDC", "NDC_CD", "merged_prod_ref")


@register("q_unmatched_patient", with_views("""
select PATIENT_ID, CLAIM_ID, YEAR from claims c
where not exists (select 1 from patient_ref p where p.PATIENT_ID_REF = c.PATIENT_ID)""", "claims", "patient_ref"))
def q_unmatched_patient(spark, sf):
    return relate.unmatched(cv.claims(spark, sf), _patients(spark, sf), "PATIENT_ID", "PATIENT_ID_REF").select(
        "PATIENT_ID", "CLAIM_ID", "YEAR")


@register("q_unmatched_product", with_views(f"""
select PATIENT_ID, CLAIM_ID, YEAR, {norm('NDC')} as NDC from claims c
where not exists (select 1 from product_silver d where d.NDC_CD = {norm('c.NDC')})""", "claims", "product_silver"))
def q_unmatched_product(spark, sf):
    c = cv.claims(spark, sf).withColumn("NDC", normalize_code("NDC"))
    return relate.unmatched(c, _products(spark, sf), "NDC", "NDC_CD").select("PATIENT_ID", "CLAIM_ID", "YEAR", "NDC")


@register("q_unmatched_extracts", with_views(f"""
select 'patient' as lookup, PATIENT_ID, CLAIM_ID, YEAR from claims c
where not exists (select 1 from patient_ref p where p.PATIENT_ID_REF = c.PATIENT_ID)
union all
select 'product' as lookup, PATIENT_ID, CLAIM_ID, YEAR from claims c
where not exists (select 1 from product_silver d where d.NDC_CD = {norm('c.NDC')})""", "claims", "patient_ref", "product_silver"))
def q_unmatched_extracts(spark, sf):
    """Both extracts of a claims run over co-located tables: from the flags of the
    silver table written, and a narrow join of the claims that silver drops."""
    from claimlake.plans.jobs import RunParams, colocate_job, unmatched_flags
    p = RunParams(base=shared_path(spark, "q_extracts"), on_duplicate="keep")
    products = _products(spark, sf)
    claims, patients = colocate_job(spark, cv.claims_bronze(spark, sf), _patients(spark, sf), p, 8)
    silver = curate.claims_clean(curate.claims_enrich(claims, patients, products))
    years = [r[0] for r in claims.rows().select("YEAR").distinct().collect()]
    io.write_year(silver, p.base, "silver", "claims", ("MARKET_NAME",), years)
    written = io.read_layer(spark, p.base, "silver", "claims", schema=silver.schema)
    flags = unmatched_flags(claims, written, years, patients, products)
    lost = F.explode(F.array_compact(F.array(*[F.when(F.col(flag) == 0, F.lit(name)) for flag, name in (("merged_pat_ref", "patient"), ("merged_prod_ref", "product"))])))
    return flags.select(lost.alias("lookup"), "PATIENT_ID", "CLAIM_ID", "YEAR")


@register("q_claims_silver", with_views("select * from silver", "silver"))
def q_claims_silver(spark, sf):
    """The silver claims table: enriched with both lookups (merge flags),
    typed, VET dropped (NULL kept), eligible or NULL states, repaired NDC."""
    return _silver(spark, sf)


# ---------------------------------------------------------------- filters
@register("q_drop_vet_keep_null", with_views(f"""
select CLAIM_ID, YEAR, PROVIDER_SPCL_CD, coalesce(PROVIDER_SPCL_CD, '{schemas.MISSING_LABEL}') as Prov
from claims where PROVIDER_SPCL_CD is distinct from 'VET'""", "claims"))
def q_drop_vet_keep_null(spark, sf):
    df = clean.exclude_value(cv.claims(spark, sf), "PROVIDER_SPCL_CD", schemas.EXCLUDED_SPECIALTY, keep_null=True)
    return df.select("CLAIM_ID", "YEAR", "PROVIDER_SPCL_CD",
                     null_label("PROVIDER_SPCL_CD", schemas.MISSING_LABEL).alias("Prov"))


@register("q_eligible_states", with_views(f"""
select CLAIM_ID, YEAR, PROVIDER_STATE from claims
where PROVIDER_SPCL_CD is distinct from 'VET' and (PROVIDER_STATE in ({STATES}) or PROVIDER_STATE is null)""",
                                           "claims"))
def q_eligible_states(spark, sf):
    novet = clean.exclude_value(cv.claims(spark, sf), "PROVIDER_SPCL_CD", schemas.EXCLUDED_SPECIALTY)
    return clean.keep_in(novet, "PROVIDER_STATE", schemas.ELIGIBLE_STATES).select("CLAIM_ID", "YEAR", "PROVIDER_STATE")


@register("q_ineligible_states", with_views(f"""
select PROVIDER_STATE, count(*) as count, coalesce(PROVIDER_STATE in ({STATES}), false) as is_valid
from claims where PROVIDER_SPCL_CD is distinct from 'VET' group by PROVIDER_STATE""", "claims"))
def q_ineligible_states(spark, sf):
    """Every state value after the VET filter with its count and whether it
    is eligible (NULL listed as its own, not eligible, value)."""
    novet = clean.exclude_value(cv.claims(spark, sf), "PROVIDER_SPCL_CD", schemas.EXCLUDED_SPECIALTY)
    return quality.valid_values(novet, "PROVIDER_STATE", schemas.ELIGIBLE_STATES)


@register("q_negative_pay", with_views("""
select MARKET_NAME, count(*) filter (where PATIENT_PAY < 0) as negative_pay, count(*) as "rows"
from silver group by MARKET_NAME""", "silver"))
def q_negative_pay(spark, sf):
    s = _silver(spark, sf)
    return s.groupBy("MARKET_NAME").agg(F.count_if(F.col("PATIENT_PAY") < 0).alias("negative_pay"),
                                        F.count(F.lit(1)).alias("rows"))


def _domain_sql(column: str, source: str, values: list[str]) -> str:
    allowed = ", ".join(f"'{v}'" for v in values)
    return f"""select '{column}' as column_name, {source} as value, count(*) as count, coalesce({source} in ({allowed}), false) as is_valid
from kept group by {source}"""


@register("q_value_domains", with_views(f"""
, kept as (select * from claims_text where PROVIDER_SPCL_CD is distinct from 'VET' and (PROVIDER_STATE in ({STATES}) or PROVIDER_STATE is null))
""" + " union all ".join(_domain_sql(c, "OPIOID_LA_SA_FLAG" if c == "OPIOID_ER_LA_FLAG" else c, v) for c, v in schemas.VALUE_DOMAINS.items()), "claims_text"))
def q_value_domains(spark, sf):
    """Values of the five coded columns of the cleaned claims, a text delivery, in one aggregation."""
    silver = curate.claims_silver(cv.claims_text(spark, sf), _patients(spark, sf), _products(spark, sf))
    return quality.value_domains(silver, schemas.VALUE_DOMAINS)


def _section_sql(name: str, value: str, source: str = "claims_text") -> str:
    return f"select '{name}' as section, cast({value} as varchar) as value, count(*) as count from {source} group by all"


_REPORT_SQL = with_views(f"""
, joined as (
  select case when p.PATIENT_ID_REF is not null then 1 else 0 end as merged_pat_ref, case when d.NDC_CD is not null then 1 else 0 end as merged_prod_ref
  from claims_text c left join patient_ref p on c.PATIENT_ID = p.PATIENT_ID_REF left join product_silver d on {norm('c.NDC')} = d.NDC_CD)
""" + " union all ".join([
    _section_sql("missing_month", "MONTH_ID is null"),
    _section_sql("specialty", "coalesce(PROVIDER_SPCL_CD, 'Missing')"),
    _section_sql("missing_specialty", "PROVIDER_SPCL_CD is null"),
    _section_sql("missing_state", "PROVIDER_STATE is null"),
    _section_sql("excluded_state", f"case when PROVIDER_STATE in ({STATES}) then 'eligible' else PROVIDER_STATE end"),
    _section_sql("ndc_length", "length(NDC)"),
    _section_sql("npi_length", "length(NPI)"),
    _section_sql("merged_pat_ref", "merged_pat_ref", "joined"),
    _section_sql("merged_prod_ref", "merged_prod_ref", "joined"),
]), "claims_text", "patient_ref", "product_silver")


@register("q_claims_report", _REPORT_SQL)
def q_claims_report(spark, sf):
    """The claims report in long form: nine sections from two passes."""
    from claimlake.plans.jobs import claims_report
    bronze = cv.claims_text(spark, sf)
    return claims_report(bronze, curate.claims_enrich(bronze, _patients(spark, sf), _products(spark, sf)))


def _check_sql(name: str, severity: str, condition: str) -> str:
    return f"select '{name}' as name, '{severity}' as severity, count(*) as value, if(count(*) = 0, 'ok', 'failed') as verdict from claims_text where {condition}"


@register("q_claims_checks", with_views("\n" + " union all ".join([
    _check_sql("claim_without_id", "error", "CLAIM_ID is null"),
    _check_sql("claim_without_year", "error", "YEAR is null"),
    _check_sql("claim_without_month", "warning", "MONTH_ID is null"),
    _check_sql("unmapped_market", "warning", "not coalesce(MARKET_NAME in ('A','B','G','M','N','O','P','S','T'), false)"),
    _check_sql("ndc_not_repairable", "warning", "length(NDC) > 12"),
    _check_sql("npi_of_other_length", "warning", "length(NPI) <> 10"),
    "select 'malformed_value', 'error', n, if(n = 0, 'ok', 'failed') from (select count(*) as n from (select unnest(list_filter([DISPENSE_DATE is not null and try_cast(DISPENSE_DATE as date) is null, "
    "QUANTITY is not null and try_cast(QUANTITY as double) is null, DAYS_SUPPLY is not null and try_cast(DAYS_SUPPLY as integer) is null, PATIENT_PAY is not null and try_cast(PATIENT_PAY as double) is null, "
    "DAYS_SINCE_LAST_OPIOID is not null and try_cast(DAYS_SINCE_LAST_OPIOID as integer) is null], lambda b: b)) from claims_text) t) u",
]), "claims_text"))
def q_claims_checks(spark, sf):
    """The checks that gate a claims delivery, with severity and verdict."""
    from claimlake.plans.jobs import claims_checks
    bronze = cv.claims_text(spark, sf)
    return claims_checks(bronze, clean.rejected_cells(bronze, curate.CLAIMS_CASTS, schemas.UPSERT_KEYS, "claims"))


@register("q_cast_rejects", with_views("""
""" + " union all ".join(
    f"select 'claims' as table_name, CLAIM_ID, YEAR, '{c}' as column_name, {c} as raw_value from claims_text where {c} is not null and try_cast({c} as {t}) is null"
    for c, t in {"DISPENSE_DATE": "date", "QUANTITY": "double", "DAYS_SUPPLY": "integer", "PATIENT_PAY": "double", "DAYS_SINCE_LAST_OPIOID": "integer"}.items()), "claims_text"))
def q_cast_rejects(spark, sf):
    """Every malformed cell of a text delivery, with its claim and raw value."""
    return clean.rejected_cells(cv.claims_text(spark, sf), curate.CLAIMS_CASTS, schemas.UPSERT_KEYS, "claims")


@register("q_quality_profile", with_views(f"""
select count(*) as "rows",
       count(*) filter (where PROVIDER_SPCL_CD = 'VET') as vet,
       count(*) filter (where PROVIDER_SPCL_CD is null) as null_specialty,
       count(*) filter (where PROVIDER_STATE not in ({STATES})) as ineligible_state,
       count(*) filter (where PROVIDER_STATE is null) as null_state,
       count(*) filter (where PATIENT_PAY < 0) as negative_pay,
       count(*) filter (where length(NDC) <> 11) as ndc_bad_length,
       count(*) filter (where length(NPI) <> 10) as npi_bad_length
from claims""", "claims"))
def q_quality_profile(spark, sf):
    """All row-count checks of the claims stage in one pass."""
    c, st = F.col, F.col("PROVIDER_STATE")
    return quality.profile(cv.claims(spark, sf), {
        "vet": c("PROVIDER_SPCL_CD") == schemas.EXCLUDED_SPECIALTY,
        "null_specialty": c("PROVIDER_SPCL_CD").isNull(),
        "ineligible_state": ~st.isin(schemas.ELIGIBLE_STATES),
        "null_state": st.isNull(),
        "negative_pay": c("PATIENT_PAY") < 0,
        "ndc_bad_length": F.length("NDC") != schemas.NDC_WIDTH,
        "npi_bad_length": F.length("NPI") != schemas.NPI_WIDTH,
    })


# ---------------------------------------------------------------- statistics
@register("q_summary_stats", with_views("""
select MARKET_NAME, round(avg(QUANTITY), 6) as mean, round(stddev_samp(QUANTITY), 6) as stddev,
       min(QUANTITY) as min, max(QUANTITY) as max, count(QUANTITY) as count
from claims group by MARKET_NAME""", "claims"))
def q_summary_stats(spark, sf):
    s = stats.summary_stats(cv.claims(spark, sf), "QUANTITY", "MARKET_NAME")
    return s.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


def _fences_sql(col: str, src: str) -> str:
    return f"""fences as (
  select q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from (
    select cast(quantile_disc({col}, 0.25) as double) as q1, cast(quantile_disc({col}, 0.75) as double) as q3
    from {src} where {col} is not null))"""


@register("q_count_outliers", with_views(f"""
, {_fences_sql('PATIENT_PAY', 'claims')}
select MARKET_NAME, count(*) as outlier_count from claims, fences
where PATIENT_PAY < lower or PATIENT_PAY > upper group by MARKET_NAME""", "claims"))
def q_count_outliers(spark, sf):
    return stats.count_outliers(cv.claims(spark, sf), "PATIENT_PAY", "MARKET_NAME")


def _robust_sql(col: str) -> str:
    return with_views(f"""
, {_fences_sql(col, 'silver')}
select MARKET_NAME, count({col}) as total_observations, min({col}) as min,
       cast(quantile_disc({col}, 0.5) as double) as median,
       round(avg({col}), 2) as mean, round(stddev_samp({col}), 2) as stddev, max({col}) as max,
       count(*) filter (where {col} < (select lower from fences) or {col} > (select upper from fences)) as count_outliers,
       round(count(*) filter (where {col} < (select lower from fences) or {col} > (select upper from fences))
             / count({col}) * 100, 2) as percentage_outliers
from silver group by MARKET_NAME""", "silver")


def _robust(col: str) -> QueryFn:
    def fn(spark, sf):
        return stats.robust_summary(_silver(spark, sf), col, "MARKET_NAME")
    fn.__doc__ = f"Robust summary of {col} by market over the cleaned claims."
    return fn


register("q_robust_summary", _robust_sql("PATIENT_PAY"))(_robust("PATIENT_PAY"))
register("q_robust_summary_quantity", _robust_sql("QUANTITY"))(_robust("QUANTITY"))
register("q_robust_summary_days_supply", _robust_sql("DAYS_SUPPLY"))(_robust("DAYS_SUPPLY"))


def _all_summaries_sql() -> str:
    parts = []
    for c in ("QUANTITY", "PATIENT_PAY", "DAYS_SUPPLY"):
        body = _robust_sql(c)
        parts.append(f"""select '{c}' as measure, MARKET_NAME, total_observations, cast(min as double) as min, median, mean, stddev,
  cast(max as double) as max, count_outliers, percentage_outliers from ({body}) r""")
    return " union all ".join(parts)


@register("q_robust_summaries", _all_summaries_sql())
def q_robust_summaries(spark, sf):
    """Robust summaries of three measures by market, global fences and group medians in shared passes."""
    return stats.robust_summaries(_silver(spark, sf), ["QUANTITY", "PATIENT_PAY", "DAYS_SUPPLY"], "MARKET_NAME")


ORACLE_OF_QUANTILES = with_views("""
select YEAR, cast(quantile_disc(PATIENT_PAY, 0.1) as double) as p10, cast(quantile_disc(PATIENT_PAY, 0.5) as double) as p50,
       cast(quantile_disc(PATIENT_PAY, 0.9) as double) as p90
from claims where PATIENT_PAY is not null group by YEAR""", "claims")


@register("q_quantiles_by_year", ORACLE_OF_QUANTILES)
def q_quantiles_by_year(spark, sf):
    """Exact discrete deciles of patient pay per year (distributed selection)."""
    return stats.quantiles(cv.claims(spark, sf), "PATIENT_PAY", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, by=["YEAR"])


# ---------------------------------------------------------------- markets
_BENZO_FLAG_SQL = """(select NDC, case PROD_CUSTOM_LVL1_DESC when 'BENZODIAZEPINES' then 'B' when 'OTHER' then 'OS' end
   as BENZO_FLAG from benzo_def)"""


@register("q_benzo_split", with_views(f"""
select s.CLAIM_ID, s.YEAR, s.NDC, f.BENZO_FLAG as MARKET_NAME, case when f.BENZO_FLAG is not null then 1 else 0 end as merged
from silver s left join {_BENZO_FLAG_SQL} f on s.NDC = f.NDC where s.MARKET_NAME = 'B'""", "silver", "benzo_def"))
def q_benzo_split(spark, sf):
    split = markets.benzo_split(_gold_input(spark, sf), cv.benzo_def(spark, sf))
    return split.select("CLAIM_ID", "YEAR", "NDC", "MARKET_NAME", "merged")


_RULE_SQL = """(select *, case when USC_CD = '78340' and GPI_DESC <> 'Methadone HCl Conc 10 MG/ML' then 'BU' else 'O' end
   as MARKET_NAME, case when USC_CD = '78340' then 1 else 0 end as MOUD from opioid_def)"""


@register("q_opioid_rule", with_views(f"select NDC, USC_CD, GPI_DESC, MARKET_NAME, MOUD from {_RULE_SQL} r",
                                      "opioid_def"))
def q_opioid_rule(spark, sf):
    return markets.opioid_rule(cv.opioid_def(spark, sf)).select("NDC", "USC_CD", "GPI_DESC", "MARKET_NAME", "MOUD")


_MME_ENRICH = f"""(select s.* exclude (MARKET_NAME), m.* exclude (NDC, NDC_Numeric),
    case when m.PRODNME is not null then 1 else 0 end as MERGED
  from silver s left join mme m on s.NDC = m.NDC where s.MARKET_NAME = 'O')"""


@register("q_mme_enrich", with_views(f"""
select CLAIM_ID, YEAR, NDC, PRODNME, LONGSHORTACTING, STRENGTH_PER_UNIT, MME_CONVERSION_FACTOR, MERGED
from {_MME_ENRICH} e""", "silver", "mme"))
def q_mme_enrich(spark, sf):
    e = markets.mme_enrich(_gold_input(spark, sf), cv.mme(spark, sf))
    return e.select("CLAIM_ID", "YEAR", "NDC", "PRODNME", "LONGSHORTACTING", "STRENGTH_PER_UNIT",
                    "MME_CONVERSION_FACTOR", "MERGED")


@register("q_unmatched_ndc", with_views(f"""
select NDC, count(*) as count from {_MME_ENRICH} e where MERGED = 0 group by NDC""", "silver", "mme"))
def q_unmatched_ndc(spark, sf):
    return markets.unmatched_ndc(markets.mme_enrich(_gold_input(spark, sf), cv.mme(spark, sf)))


def _opioid_gold_sql(code: str, cols: list[str], table: str) -> str:
    return with_views(f"""
select {_gold_cols_sql(cols)}, '{RUN_DATE}' as UPDATE_DATE, '{table}' as GOLD_TABLE
from (select e.*, r.MARKET_NAME, r.MOUD from {_MME_ENRICH} e join {_RULE_SQL} r on e.NDC = r.NDC) g
where MARKET_NAME = '{code}'""", "silver", "mme", "opioid_def")


def _enriched(spark, sf):
    return markets.mme_enrich(_gold_input(spark, sf), cv.mme(spark, sf))


@register("q_bupe_gold", _opioid_gold_sql("BU", schemas.BUPRENORPHINE_GOLD_COLUMNS, "buprenorphine"))
def q_bupe_gold(spark, sf):
    return markets.buprenorphine_gold(_enriched(spark, sf), cv.opioid_def(spark, sf), RUN_DATE)


@register("q_opioid_gold", _opioid_gold_sql("O", schemas.OPIOID_GOLD_COLUMNS, "opioid"))
def q_opioid_gold(spark, sf):
    return markets.opioid_gold(_enriched(spark, sf), cv.opioid_def(spark, sf), RUN_DATE)


@register("q_market_split", with_views(f"""
select {_gold_cols_sql(schemas.NON_OPIOID_GOLD_COLUMNS)}, '{RUN_DATE}' as UPDATE_DATE,
       {_case_sql('MARKET_NAME', schemas.NON_OPIOID_MARKETS)} as GOLD_TABLE
from silver where MARKET_NAME in ('A', 'G', 'M', 'P', 'S', 'T')""", "silver"))
def q_market_split(spark, sf):
    """Additional markets: six gold tables' rows, routed by GOLD_TABLE."""
    return markets.non_opioid_gold(_gold_input(spark, sf), RUN_DATE)


_BENZO_GOLD_SQL = f"""
select {_gold_cols_sql(schemas.OPIOID_FILE_GOLD_COLUMNS)}, '{RUN_DATE}' as UPDATE_DATE, 'naloxone' as GOLD_TABLE
from silver where MARKET_NAME = 'N'
union all
select {_gold_cols_sql(schemas.OPIOID_FILE_GOLD_COLUMNS)}, '{RUN_DATE}' as UPDATE_DATE,
       {_case_sql('MARKET_NAME', schemas.BENZO_MARKETS)} as GOLD_TABLE
from (select s.* exclude (MARKET_NAME), f.BENZO_FLAG as MARKET_NAME
      from silver s left join {_BENZO_FLAG_SQL} f on s.NDC = f.NDC where s.MARKET_NAME = 'B') b
where MARKET_NAME is not null"""


@register("q_naloxone_benzo_gold", with_views(_BENZO_GOLD_SQL, "silver", "benzo_def"))
def q_naloxone_benzo_gold(spark, sf):
    """Opioid-file markets without MME: naloxone, benzodiazepines, other sedatives."""
    g = _gold_input(spark, sf)
    nal = markets.naloxone_gold(g, RUN_DATE)
    benzo = markets.benzo_gold(markets.benzo_split(g, cv.benzo_def(spark, sf)), RUN_DATE)
    return nal.unionByName(benzo)


@register("q_unrouted", with_views(f"""
select CLAIM_ID, YEAR, PATIENT_ID, NDC, MARKET_NAME, 'unmapped_market' as REASON from silver
where not coalesce(MARKET_NAME in ('A','B','G','M','N','O','P','S','T'), false)
union all
select s.CLAIM_ID, s.YEAR, s.PATIENT_ID, s.NDC, 'B', 'no_benzo_flag'
from silver s left join {_BENZO_FLAG_SQL} f on s.NDC = f.NDC where s.MARKET_NAME = 'B' and f.BENZO_FLAG is null
union all
select CLAIM_ID, YEAR, PATIENT_ID, NDC, 'O', 'no_market_definition' from silver s
where s.MARKET_NAME = 'O' and not exists (select 1 from opioid_def d where d.NDC = s.NDC)""",
                                   "silver", "benzo_def", "opioid_def"))
def q_unrouted(spark, sf):
    """Claims no gold table takes, with the reason (quarantine)."""
    g = _gold_input(spark, sf)
    split = markets.benzo_split(g, cv.benzo_def(spark, sf))
    return markets.unrouted(g, split, _enriched(spark, sf), cv.opioid_def(spark, sf))


# ---------------------------------------------------------------- sinks
_UPSERT_SQL = with_views("""
, t1 as (select *, '2024-01-01' as UPDATE_DATE from claims),
s2 as (select *, '2024-02-01' as UPDATE_DATE from claims where RX_TYPE = 'R')
select * from t1 where not exists (select 1 from s2 where s2.CLAIM_ID = t1.CLAIM_ID and s2.YEAR = t1.YEAR)
union all select * from s2""", "claims")


def _claims_once(spark, sf, name):
    """All claims, joined and stored once for several deliveries."""
    with sparing_disk(spark):
        return materialize(cv.claims(spark, sf, orders_first=True), name, codec=CODEC)


@register("q_upsert", _UPSERT_SQL)
def q_upsert(spark, sf):
    """Initial load of every claim, then refills re-delivered twice with a new
    UPDATE_DATE (upsert on CLAIM_ID, YEAR); the table is read back."""
    path = shared_path(spark, "q_upsert")
    c = _claims_once(spark, sf, "q_upsert-claims")
    upsert(spark, clean.stamp(c, "2024-01-01"), path, on_duplicate="keep", stage_source=False)  # the view repeats some keys
    refills = clean.stamp(c.where(F.col("RX_TYPE") == "R"), "2024-02-01")
    upsert(spark, refills, path, on_duplicate="keep", stage_source=False)
    upsert(spark, refills, path, on_duplicate="keep", stage_source=False)  # a re-run changes nothing
    return spark.read.schema(clean.stamp(c, "x").schema).parquet(path)


_YEAR_TOTALS_SQL = with_views(f"""
, g as (
  select {_case_sql('MARKET_NAME', schemas.NON_OPIOID_MARKETS)} as GOLD_TABLE, YEAR from silver
  where MARKET_NAME in ('A', 'G', 'M', 'P', 'S', 'T')
  union all select 'naloxone', YEAR from silver where MARKET_NAME = 'N'
  union all select {_case_sql('f.BENZO_FLAG', schemas.BENZO_MARKETS)}, s.YEAR
    from silver s join {_BENZO_FLAG_SQL} f on s.NDC = f.NDC where s.MARKET_NAME = 'B' and f.BENZO_FLAG is not null
  union all select case r.MARKET_NAME when 'BU' then 'buprenorphine' else 'opioid' end, s.YEAR
    from silver s join {_RULE_SQL} r on s.NDC = r.NDC where s.MARKET_NAME = 'O')
select GOLD_TABLE, YEAR, count(*) as count from g group by GOLD_TABLE, YEAR""",
                              "silver", "benzo_def", "opioid_def")


@register("q_gold_year_totals", _YEAR_TOTALS_SQL)
def q_gold_year_totals(spark, sf):
    """Full gold stage: silver claims written, eleven gold tables upserted,
    rows per table and YEAR read back from gold."""
    from claimlake.plans.jobs import RunParams, gold_job
    base = shared_path(spark, "q_gold")
    p = RunParams(base=base, run_date=RUN_DATE, on_duplicate="keep")  # the views repeat some keys
    io.write_layer(_silver(spark, sf), base, "silver", "claims", ("YEAR", "MARKET_NAME"))
    silver = io.read_layer(spark, base, "silver", "claims")
    out = gold_job(spark, silver, cv.benzo_def(spark, sf), cv.opioid_def(spark, sf), cv.mme(spark, sf), p)
    return out["year_totals"]


# ---------------------------------------------------------------- above the bounds, second deliveries
_SHUFFLE_PAT_SQL = with_views("""
, c as (select CLAIM_ID, YEAR, case when cast(PATIENT_ID as bigint) % 9 <> 0 then cast(PATIENT_ID as bigint) end as PATIENT_ID from claims)
select c.CLAIM_ID, c.YEAR, c.PATIENT_ID, cast(p.PATIENT_ID_REF as bigint) as PATIENT_ID_REF, p.PATIENT_GENDER,
       case when p.PATIENT_ID_REF is not null then 1 else 0 end as merged_pat_ref
from c left join patient_ref p on c.PATIENT_ID = cast(p.PATIENT_ID_REF as bigint)""", "claims", "patient_ref")


@register("q_left_patient_shuffle", _SHUFFLE_PAT_SQL)
def q_left_patient_shuffle(spark, sf):
    """The patient join above the broadcast bound, with integer keys and NULL keys."""
    key = F.col("PATIENT_ID").cast("long")
    c = cv.claims(spark, sf).select("CLAIM_ID", "YEAR", F.when(key % 9 != 0, key).alias("PATIENT_ID"))
    p = _patients(spark, sf).withColumn("PATIENT_ID_REF", F.col("PATIENT_ID_REF").cast("long"))
    j = relate.left_join_flag(c, p, "PATIENT_ID", "PATIENT_ID_REF", flag="merged_pat_ref", broadcast_max_rows=0)
    return j.select("CLAIM_ID", "YEAR", "PATIENT_ID", "PATIENT_ID_REF", "PATIENT_GENDER", "merged_pat_ref")


@register("q_left_product_shuffle", _LEFT_PROD_SQL)
def q_left_product_shuffle(spark, sf):
    """The product join above the broadcast bound."""
    c = cv.claims(spark, sf).withColumn("NDC", normalize_code("NDC"))
    j = relate.left_join_flag(c, _products(spark, sf), "NDC", "NDC_CD", flag="merged_prod_ref", broadcast_max_rows=0)
    return j.select("CLAIM_ID", "YEAR", "NDC", "NDC_CD", "USC_CD", "ROUTE_ADM_NM", "merged_prod_ref")


@register("q_quantiles_by_year_large", ORACLE_OF_QUANTILES)
def q_quantiles_by_year_large(spark, sf):
    """The rounds for large groups, over all claims: no group is small enough to be ranked at once."""
    return stats.quantiles(cv.claims(spark, sf), "PATIENT_PAY", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, by=["YEAR"], max_exact_rows=100)


@register("q_robust_summary_large", _robust_sql("PATIENT_PAY"))
def q_robust_summary_large(spark, sf):
    """The robust summary with every group above the bound for ranking at once."""
    return stats.robust_summary(_silver(spark, sf), "PATIENT_PAY", "MARKET_NAME", max_exact_rows=100)


@register("q_claims_silver_multiyear", with_views("""
select YEAR, MARKET_NAME, merged_pat_ref, merged_prod_ref, count(*) as n_claims from silver
group by YEAR, MARKET_NAME, merged_pat_ref, merged_prod_ref""", "silver"))
def q_claims_silver_multiyear(spark, sf):
    """Claims joined with lookups of many years: each meets its own year's, so their number stays."""
    every = F.explode(F.sequence(F.lit(1990), F.lit(2010)))
    silver = curate.claims_silver(cv.claims_bronze(spark, sf), _patients(spark, sf).withColumn("YEAR", every),
                                  _products(spark, sf).withColumn("YEAR", every), on_duplicate="error")
    return silver.groupBy("YEAR", "MARKET_NAME", "merged_pat_ref", "merged_prod_ref").agg(F.count(F.lit(1)).alias("n_claims"))


@register("q_rerun_year", with_views("""
select YEAR, MARKET_NAME, count(*) as n_claims from claims
where not (YEAR = 1995 and MARKET_NAME in ('A', 'O')) group by YEAR, MARKET_NAME""", "claims"))
def q_rerun_year(spark, sf):
    """A year delivered again without two markets: nothing of its first delivery stays, other years do."""
    base = shared_path(spark, "q_rerun")
    c = cv.claims(spark, sf)
    io.write_year(c, base, "silver", "claims", ("MARKET_NAME",))
    io.write_year(c.where("YEAR = 1995 AND MARKET_NAME NOT IN ('A', 'O')"), base, "silver", "claims", ("MARKET_NAME",))
    return io.read_layer(spark, base, "silver", "claims", schema=c.schema).groupBy("YEAR", "MARKET_NAME").agg(F.count(F.lit(1)).alias("n_claims"))


_NULL_KEYS_SQL = with_views("""
, k as (select case when DAYS_SUPPLY <> 30 then CLAIM_ID end as CLAIM_ID, case when DAYS_SUPPLY <> 40 then YEAR end as YEAR, RX_TYPE, MARKET_NAME from claims),
t as (select *, 'first' as DELIVERY from k),
d as (select *, 'second' as DELIVERY from k where RX_TYPE = 'R'),
u as (select * from t where not exists (select 1 from d where d.CLAIM_ID = t.CLAIM_ID and d.YEAR = t.YEAR) union all select * from d)
select YEAR, MARKET_NAME, DELIVERY, CLAIM_ID is null as no_id, count(*) as n_claims from u group by all""", "claims")


@register("q_upsert_null_keys", _NULL_KEYS_SQL)
def q_upsert_null_keys(spark, sf):
    """An upsert with NULL ids and NULL years: such rows match nothing; those stored stay, those delivered are added."""
    path = shared_path(spark, "q_upsert_null")
    c = cv.claims(spark, sf).select(
        F.when(F.col("DAYS_SUPPLY") != 30, F.col("CLAIM_ID")).alias("CLAIM_ID"), F.when(F.col("DAYS_SUPPLY") != 40, F.col("YEAR")).alias("YEAR"),
        "RX_TYPE", "MARKET_NAME")
    upsert(spark, c.withColumn("DELIVERY", F.lit("first")), path, on_duplicate="keep")
    second = c.where("RX_TYPE = 'R'").withColumn("DELIVERY", F.lit("second"))
    upsert(spark, second, path, on_duplicate="keep")
    stored = spark.read.schema(second.schema).parquet(path)
    return stored.groupBy("YEAR", "MARKET_NAME", "DELIVERY", F.col("CLAIM_ID").isNull().alias("no_id")).agg(F.count(F.lit(1)).alias("n_claims"))


@register("q_upsert_duplicates", with_views("""
, ranked as (select CLAIM_ID, YEAR, max(DISPENSE_DATE) as DISPENSE_DATE from claims group by CLAIM_ID, YEAR)
select YEAR, count(*) as n_claims, max(DISPENSE_DATE) as last_dispense, min(DISPENSE_DATE) as first_dispense from ranked group by YEAR""", "claims"))
def q_upsert_duplicates(spark, sf):
    """Repeated keys resolved to the latest dispense before they are stored; a second delivery changes nothing."""
    path = shared_path(spark, "q_upsert_dup")
    c = _claims_once(spark, sf, "q_upsert_dup-claims")
    for _ in range(2):
        upsert(spark, c, path, on_duplicate="latest", latest="DISPENSE_DATE", stage_source=False)
    stored = spark.read.schema(c.schema).parquet(path)
    return stored.groupBy("YEAR").agg(F.count(F.lit(1)).alias("n_claims"), F.max("DISPENSE_DATE").alias("last_dispense"), F.min("DISPENSE_DATE").alias("first_dispense"))


# ---------------------------------------------------------------- keyed store
_SMALL_DELTA_SQL = with_views("""
, t1 as (select *, '2024-01-01' as UPDATE_DATE from claims),
s2 as (select *, '2024-02-01' as UPDATE_DATE from claims where MONTH_ID = 199506)
select * from t1 where not exists (select 1 from s2 where s2.CLAIM_ID = t1.CLAIM_ID and s2.YEAR = t1.YEAR)
union all select * from s2""", "claims")


@register("q_upsert_small_delta", _SMALL_DELTA_SQL)
def q_upsert_small_delta(spark, sf):
    """All claims in a bucketed table, then one month delivered again: only its claims' buckets are read and written."""
    path = shared_path(spark, "q_small_delta")
    c = cv.claims(spark, sf)
    for rows, date in ((c, "2024-01-01"), (c.where("MONTH_ID = 199506"), "2024-02-01")):
        merge_into(spark, clean.stamp(rows, date), path, buckets=8, on_duplicate="keep")  # the view repeats some keys
    return read_store(spark, path)


def _store_select(columns: list[str], table: str, source: str, market: str = "MARKET_NAME") -> str:
    """Columns of the one gold table; those that a market lacks are NULL."""
    src = {"INGESTION_DATE": "ingestion_date", "MARKET_NAME": market}
    types = {"STRENGTH_PER_UNIT": "double", "MME_CONVERSION_FACTOR": "double", "MOUD": "integer"}
    cols = [f"{src.get(c, c)} as {c}" if c in columns else f"cast(null as {types.get(c, 'varchar')}) as {c}" for c in schemas.OPIOID_GOLD_COLUMNS]
    return f"select {', '.join(cols)}, '{RUN_DATE}' as UPDATE_DATE, {table} as GOLD_TABLE from {source}"


def _desc(columns: list[str]) -> str:
    return ", ".join(f"{c} desc nulls last" for c in columns)


_RESOLVED_SQL = f"""
, b as (select s.* exclude (MARKET_NAME), f.BENZO_FLAG as MARKET_NAME
        from silver s left join {_BENZO_FLAG_SQL} f on s.NDC = f.NDC where s.MARKET_NAME = 'B'),
o as (select s.* exclude (MARKET_NAME), m.* exclude (NDC, NDC_Numeric), r.MARKET_NAME, case when r.MARKET_NAME = 'O' then r.MOUD end as MOUD
      from silver s left join mme m on s.NDC = m.NDC left join {_RULE_SQL} r on s.NDC = r.NDC where s.MARKET_NAME = 'O'),
routed as (
  {_store_select(schemas.NON_OPIOID_GOLD_COLUMNS, _case_sql('MARKET_NAME', schemas.NON_OPIOID_MARKETS), "silver where MARKET_NAME in ('A', 'G', 'M', 'P', 'S', 'T')")}
  union all {_store_select(schemas.OPIOID_FILE_GOLD_COLUMNS, "'naloxone'", "silver where MARKET_NAME = 'N'")}
  union all {_store_select(schemas.OPIOID_FILE_GOLD_COLUMNS, _case_sql('MARKET_NAME', schemas.BENZO_MARKETS), 'b where MARKET_NAME is not null')}
  union all {_store_select(schemas.OPIOID_GOLD_COLUMNS, _case_sql('MARKET_NAME', schemas.OPIOID_MARKETS), 'o where MARKET_NAME is not null')}),
gold as (select * from routed qualify row_number() over (partition by GOLD_TABLE, CLAIM_ID, YEAR
  order by {_desc(['DISPENSE_DATE', *[c for c in schemas.GOLD_STORE_COLUMNS if c not in ('CLAIM_ID', 'YEAR', 'DISPENSE_DATE')]])}) = 1),
unrouted as (
  select CLAIM_ID, YEAR, PATIENT_ID, NDC, 'B' as MARKET_NAME, DISPENSE_DATE, 'no_benzo_flag' as REASON from b where MARKET_NAME is null
  union all select CLAIM_ID, YEAR, PATIENT_ID, NDC, 'O', DISPENSE_DATE, 'no_market_definition' from o where MARKET_NAME is null),
quarantine as (select * from unrouted u where not exists (
    select 1 from gold g where g.CLAIM_ID = u.CLAIM_ID and g.YEAR = u.YEAR and g.DISPENSE_DATE >= u.DISPENSE_DATE)
  qualify row_number() over (partition by CLAIM_ID, YEAR order by {_desc(['DISPENSE_DATE', 'PATIENT_ID', 'NDC', 'MARKET_NAME', 'REASON'])}) = 1)"""


def _gold_run(spark, sf, base: str, streamed: bool):
    """All gold tables and the quarantine of the claims, versions of a claim resolved by DISPENSE_DATE."""
    from claimlake.plans.jobs import RunParams, gold_job
    p = RunParams(base=base, run_date=RUN_DATE, on_duplicate="latest", latest="DISPENSE_DATE")
    lookups = (cv.benzo_def(spark, sf), cv.opioid_def(spark, sf), cv.mme(spark, sf))
    if not streamed:
        io.write_layer(_silver(spark, sf), base, "silver", "claims", ("YEAR", "MARKET_NAME"))
        gold_job(spark, io.read_layer(spark, base, "silver", "claims"), *lookups, p)
        return p
    from claimlake.streaming import incremental
    # files as they come: a claim's versions lie in several files, so in several micro-batches
    cv.claims_bronze(spark, sf).repartition(12).write.parquet(f"{base}/landing")
    query = incremental.start(spark, f"{base}/landing", f"{base}/_checkpoint", _patients(spark, sf), _products(spark, sf),
                              *lookups, p, available_now=True, max_files_per_trigger=4)
    query.awaitTermination()
    return p


def _gold_rows(spark, p):
    from claimlake.plans.jobs import read_quarantine
    gold = read_store(spark, io.layer_path(p.base, "gold", io.GOLD_DATASET))
    return gold.unionByName(read_quarantine(spark, p), allowMissingColumns=True)


_GOLD_ROWS_SQL = with_views(_RESOLVED_SQL + """
select *, cast(null as varchar) as REASON from gold
union all by name select * from quarantine""", "silver", "benzo_def", "opioid_def", "mme")


@register("q_gold_rows", _GOLD_ROWS_SQL)
def q_gold_rows(spark, sf):
    """Every row of the eleven gold tables and of the quarantine (GOLD_TABLE NULL) after a batch run."""
    return _gold_rows(spark, _gold_run(spark, sf, shared_path(spark, "q_gold_rows"), streamed=False))


@register("q_export_roundtrip", with_views(_RESOLVED_SQL + f"""
select * exclude ({', '.join(schemas.PRODUCT_COLUMNS)}) from gold""", "silver", "benzo_def", "opioid_def", "mme"))
def q_export_roundtrip(spark, sf):
    """All eleven gold tables exported as CSV (one folder per YEAR, product columns
    left out) and read back with their schemas."""
    from claimlake.plans.jobs import export_job
    p = _gold_run(spark, sf, shared_path(spark, "q_export"), streamed=False)
    out = None
    for table, path in zip(schemas.GOLD_MARKETS, export_job(spark, p, f"{p.base}/exports", profile="without_product"), strict=True):
        schema = io.read_gold(spark, p.base, table).drop(*schemas.PRODUCT_COLUMNS).schema
        back = io.read_export(spark, path, schema).withColumn("GOLD_TABLE", F.lit(table))
        out = back if out is None else out.unionByName(back, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- streaming
@register("q_stream_gold_totals", with_views(_RESOLVED_SQL + """
select GOLD_TABLE, YEAR, count(*) as count from gold group by GOLD_TABLE, YEAR""", "silver", "benzo_def", "opioid_def", "mme"))
def q_stream_gold_totals(spark, sf):
    """Incremental load: the bronze claims land as files, a Structured Streaming
    query merges every micro-batch into gold; rows by table and YEAR."""
    p = _gold_run(spark, sf, shared_path(spark, "q_stream"), streamed=True)
    return read_store(spark, io.layer_path(p.base, "gold", io.GOLD_DATASET)).groupBy("GOLD_TABLE", "YEAR").count()


@register("q_stream_gold_rows", _GOLD_ROWS_SQL)
def q_stream_gold_rows(spark, sf):
    """Every row of gold and quarantine after the incremental load: the batch run's rows."""
    return _gold_rows(spark, _gold_run(spark, sf, shared_path(spark, "q_stream_rows"), streamed=True))


_YEARS_SQL = """
, y as (select cast(YEAR as varchar) as YEAR, YEAR % 3 as m, CLAIM_ID, DAYS_SUPPLY,
  case when YEAR % 3 = 2 then floor(QUANTITY) else QUANTITY end as QUANTITY,
  case when YEAR % 3 <> 1 then PROVIDER_STATE end as PROVIDER_STATE, case when YEAR % 3 = 2 then NPI end as NPI from claims)"""


def _deliveries(spark, sf, name: str) -> str:
    """Claims years written as three kinds of delivery that differ in types and columns."""
    path = shared_path(spark, name)
    c = cv.claims(spark, sf)
    kinds = [
        ("CLAIM_ID", "DAYS_SUPPLY", "QUANTITY", "PROVIDER_STATE"),
        ("CLAIM_ID", F.col("DAYS_SUPPLY").cast("long").alias("DAYS_SUPPLY"), "QUANTITY"),
        ("CLAIM_ID", F.col("DAYS_SUPPLY").cast("short").alias("DAYS_SUPPLY"), F.floor("QUANTITY").cast("int").alias("QUANTITY"), "PROVIDER_STATE", "NPI"),
    ]
    for kind, columns in enumerate(kinds):
        c.where(F.col("YEAR") % 3 == kind).select("YEAR", *columns).write.mode("append").partitionBy("YEAR").parquet(path)
    return path


@register("q_schema_years", with_views(_YEARS_SQL + """
select CLAIM_ID, DAYS_SUPPLY, QUANTITY, PROVIDER_STATE, NPI, YEAR from y""", "claims"))
def q_schema_years(spark, sf):
    """Years of differing types and columns read as one table through the plan of safe casts."""
    return reconcile.read_years(spark, _deliveries(spark, sf, "q_schema_years")).select("CLAIM_ID", "DAYS_SUPPLY", "QUANTITY", "PROVIDER_STATE", "NPI", "YEAR")


@register("q_schema_years_report", with_views(_YEARS_SQL + """
, n as (select YEAR, m, count(CLAIM_ID) as a, count(DAYS_SUPPLY) as b, count(QUANTITY) as c, count(PROVIDER_STATE) as d, count(NPI) as e from y group by all),
l as (select *, lag(m) over (order by YEAR) as before from n)
select YEAR as year, 'CLAIM_ID' as "column", 'string' as stored_type, 'string' as target_type, 'same' as status, a as filled from l
union all select YEAR, 'DAYS_SUPPLY', case m when 0 then 'int' when 1 then 'bigint' else 'smallint' end, 'bigint', case when m = 1 then 'same' else 'widened' end, b from l
union all select YEAR, 'QUANTITY', case when m = 2 then 'int' else 'double' end, 'double', case when m = 2 then 'widened' else 'same' end, c from l
union all select YEAR, 'PROVIDER_STATE', case when m <> 1 then 'string' end, 'string', case when m = 1 then 'missing' when before = 1 then 'added' else 'same' end, d from l
union all select YEAR, 'NPI', case when m = 2 then 'string' end, 'string', case when m <> 2 then 'missing' when before is not null and before <> 2 then 'added' else 'same' end, e from l""", "claims"))
def q_schema_years_report(spark, sf):
    """What every year's schema differs in, and the values that every column has after the casts."""
    return reconcile.report(spark, _deliveries(spark, sf, "q_schema_years_report"))


_PROFILE_SQL = with_views("""
, c as (select * from claims where not (YEAR = 1995 and MARKET_NAME in ('A', 'O')))
""" + " union all ".join(f"""select MARKET_NAME, '{m}' as "column", count(*) as "rows", count({m}) as n, round(avg({m}), 6) as mean,
  round(stddev_samp({m}), 6) as stddev, cast(min({m}) as double) as min, cast(max({m}) as double) as max from c group by MARKET_NAME"""
                  for m in ("QUANTITY", "DAYS_SUPPLY", "PATIENT_PAY")), "claims")


@register("q_profile_rerun", _PROFILE_SQL)
def q_profile_rerun(spark, sf):
    """Stored profile states merged over all years, after one year was delivered again without two markets."""
    base = shared_path(spark, "q_profile_rerun")
    c, measures = cv.claims(spark, sf), ["QUANTITY", "DAYS_SUPPLY", "PATIENT_PAY"]
    profiles.write(c, measures, base, "profiles")
    profiles.write(c.where("YEAR = 1995 AND MARKET_NAME NOT IN ('A', 'O')"), measures, base, "profiles")
    out = profiles.merged(io.read_layer(spark, base, "silver", "profiles"), ("MARKET_NAME",))
    return out.select("MARKET_NAME", "column", "rows", "n", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"), "min", "max")


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql is not None}
