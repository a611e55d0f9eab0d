"""Independent SQL (DuckDB dialect) for every registered query.

The seven input views are the fixture statements; the derived steps (silver
lookups, silver claims, gold frames) are spelled out in plain SQL so that
the Spark library code is checked against a separate formulation.
"""

from __future__ import annotations

from claimlake import schemas

VIEW_SQL = {
    "claims": """
select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as CLAIM_ID,
       cast(o_custkey as string) as PATIENT_ID,
       case when l_partkey % 7 = 0 then '9' || lpad(cast(l_partkey as string), 11, '0')
            when l_partkey % 5 = 0 then cast(l_partkey as string)
            else lpad(cast(l_partkey as string), 11, '0') end as NDC,
       case l_partkey % 10 when 0 then 'O' when 1 then 'O' when 2 then 'B' when 3 then 'N' when 4 then 'A'
            when 5 then 'G' when 6 then 'M' when 7 then 'P' when 8 then 'S' else 'T' end as MARKET_NAME,
       case when l_suppkey % 11 = 0 then 'VET' when l_suppkey % 11 = 1 then null
            else 'S' || cast(l_suppkey % 11 as string) end as PROVIDER_SPCL_CD,
       case c_nationkey % 8 when 0 then 'AL' when 1 then 'CA' when 2 then 'NY' when 3 then 'TX'
            when 4 then 'PR' when 5 then 'GU' when 6 then 'WY' else null end as PROVIDER_STATE,
       case l_linestatus when 'O' then 'N' else 'R' end as RX_TYPE,
       cast(l_shipdate as date) as DISPENSE_DATE,
       cast(year(l_shipdate) * 100 + month(l_shipdate) as int) as MONTH_ID,
       cast(year(l_shipdate) as int) as YEAR,
       l_quantity as QUANTITY, l_linenumber * 10 as DAYS_SUPPLY,
       l_extendedprice * l_discount - 100 as PATIENT_PAY, cast(l_suppkey as string) as NPI
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "patient_ref": """
select cast(c_custkey as string) as PATIENT_ID_REF,
       case when c_custkey % 13 = 0 then null else cast(1930 + c_custkey % 80 as int) end as PATIENT_BRTH_YR,
       case c_custkey % 3 when 0 then 'F' when 1 then 'M' else 'U' end as PATIENT_GENDER,
       ' ' as PAT_DX_AVAIL_FLAG
from customer where c_custkey % 20 <> 0""",
    "product_ref": """
select case when p_partkey % 7 = 0 then '9' || lpad(cast(p_partkey as string), 11, '0')
            when p_partkey % 3 = 0 then cast(p_partkey as string)
            else lpad(cast(p_partkey as string), 11, '0') end as NDC_CD,
       p_name as MKTED_PROD_NM, p_brand as UNIFM_PROD_NM, p_type as ROUTE_ADM_NM,
       cast(p_size as string) as DOSAGE_FORM_NM,
       case when p_partkey % 4 = 0 then '78340' when p_partkey % 17 = 0 then '123' else '02200' end as USC_CD,
       cast(2015 + k as string) || '-01-01' as ingestion_date
from part cross join (select 0 as k union all select 1 as k) d
where p_partkey % 25 <> 0 and (k = 0 or p_partkey % 6 = 0)""",
    "benzo_def": """
select lpad(cast(p_partkey as string), 11, '0') as NDC,
       case p_partkey % 30 when 2 then 'BENZODIAZEPINES' when 12 then 'OTHER' else 'UNSPECIFIED' end as PROD_CUSTOM_LVL1_DESC
from part where p_partkey % 10 = 2""",
    "opioid_def": """
select lpad(cast(p_partkey as string), 11, '0') as NDC,
       case when p_partkey % 4 <> 0 then '02200' else '78340' end as USC_CD,
       case when p_partkey % 60 = 0 then null when p_partkey % 40 = 0 then 'Methadone HCl Conc 10 MG/ML'
            else 'Buprenorphine' end as GPI_DESC
from part where p_partkey % 10 in (0, 1) and p_partkey % 50 <> 1""",
    "mme": """
select lpad(cast(p_partkey as string), 11, '0') as NDC, p_partkey as NDC_Numeric, p_name as PRODNME, p_brand as GENNME,
       p_type as MASTER_FORM, 'Opioid' as CLASS, p_type as DRUG,
       case when p_partkey % 2 = 0 then 'LA' else 'SA' end as LONGSHORTACTING, '2' as DEACLASSCODE,
       cast(p_size as double) as STRENGTH_PER_UNIT, 'MG' as UOM,
       cast(1.5 as double) as MME_CONVERSION_FACTOR, '1.5' as MME_CONVERSION_FACTOR_N
from part where p_partkey % 10 in (0, 1) and p_partkey % 9 <> 0""",
    "manifest_raw": """
select FileName,
       case when n >= 1000 then cast(cast(floor(n / 1000) as int) as string) || ',' || lpad(cast(n % 1000 as string), 3, '0')
            else cast(n as string) end as RECORD_COUNT_RAW
from (select 'OPI_FactRx_' || cast(MONTH_ID as string) || '.txt' as FileName,
             count(*) + 1 + case when MONTH_ID % 7 = 0 then 3 else 0 end as n
      from claims where MONTH_ID <> 199603 group by MONTH_ID
      union all select 'OPI_FactRx_200201.txt', 1
      union all select 'OPI_Patient.txt', count(*) + 1 from patient_ref
      union all select 'OPI_Product.txt', count(*) + 2 from product_ref) m""",
}

RUN_DATE = "2024-12-31"


def norm(c: str, width: int = 11) -> str:
    return (f"case when length({c}) = {width + 1} then substr({c}, 2, {width}) "
            f"when length({c}) < {width} then lpad({c}, {width}, '0') else {c} end")


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


STATES = _in_list(schemas.ELIGIBLE_STATES)

_NULL_BRONZE = {
    "CHNL_CD": "varchar", "PROVIDER_ZIP": "varchar", "PROVIDER_ST_CNTY_FIPS_CD": "varchar",
    "OPIOID_LA_SA_FLAG": "varchar", "MARKET_NEW_FLAG": "varchar", "IQVIA_PRESCRIBER_ID": "varchar",
    "MODEL_TYP_CD": "varchar", "DAYS_SINCE_LAST_OPIOID": "integer", "ingestion_date": "date",
}


def _bronze_select() -> str:
    cols = []
    for c in schemas.CLAIMS_COLUMNS:
        if c in _NULL_BRONZE:
            cols.append(f"cast(null as {_NULL_BRONZE[c]}) as {c}")
        elif c == "MONTH_ID":
            cols.append("cast(MONTH_ID as varchar) as MONTH_ID")
        else:
            cols.append(c)
    return "select " + ", ".join(cols) + " from claims"


_TEXT_CHANGED = {
    "CLAIM_ID": "case when DAYS_SUPPLY <> 70 or RX_TYPE <> 'R' then CLAIM_ID end",
    "MARKET_NAME": "case when DAYS_SUPPLY = 50 then 'Z' else MARKET_NAME end",
    "CHNL_CD": "case when DAYS_SUPPLY <= 40 then 'R' when DAYS_SUPPLY = 60 then 'M' end",
    "OPIOID_LA_SA_FLAG": "case DAYS_SUPPLY when 10 then 'L' when 20 then 'S' when 30 then 'LA' end",
    "MARKET_NEW_FLAG": "case when RX_TYPE = 'N' then 'Y' else 'N' end",
    "DISPENSE_DATE": "case when DAYS_SUPPLY = 30 and RX_TYPE = 'N' then '1995-13-45' else cast(DISPENSE_DATE as varchar) end",
    "QUANTITY": "case when DAYS_SUPPLY = 20 and QUANTITY > 45 then 'n/a' else cast(cast(QUANTITY as integer) as varchar) end",
    "PATIENT_PAY": "case when DAYS_SUPPLY = 40 and QUANTITY > 40 then '12..5' else cast(cast(floor(PATIENT_PAY) as bigint) as varchar) end",
    "DAYS_SINCE_LAST_OPIOID": "case DAYS_SUPPLY when 10 then 'unknown' when 20 then '14' end",
}


def _text_select() -> str:
    """The claims as text (see ``claims_view.claims_text``)."""
    cols = []
    for c in schemas.CLAIMS_COLUMNS:
        value = _TEXT_CHANGED.get(c, "null" if c in _NULL_BRONZE else c)
        cols.append(f"cast({value} as varchar) as {c}")
    return "select " + ", ".join(cols) + " from claims"


DERIVED_SQL = {
    "claims_text": _text_select(),
    # product lookup: repaired code, one row per code, latest delivery first
    "product_silver": f"""
select NDC_CD, MKTED_PROD_NM, MKTED_PROD_FORMLTN_NM, ROUTE_ADM_NM, DOSAGE_FORM_NM, UNIFM_PROD_NM, USC_CD, ingestion_date
from (select *, row_number() over (partition by NDC_CD order by ingestion_date desc nulls last,
          MKTED_PROD_NM desc nulls last, MKTED_PROD_FORMLTN_NM desc nulls last, ROUTE_ADM_NM desc nulls last,
          DOSAGE_FORM_NM desc nulls last, UNIFM_PROD_NM desc nulls last, USC_CD desc nulls last) as rn
      from (select {norm('NDC_CD')} as NDC_CD, MKTED_PROD_NM, cast(null as varchar) as MKTED_PROD_FORMLTN_NM,
                   ROUTE_ADM_NM, DOSAGE_FORM_NM, UNIFM_PROD_NM, USC_CD, try_cast(ingestion_date as date) as ingestion_date
            from product_ref) p) r
where rn = 1""",
    "claims_bronze": _bronze_select(),
    "silver": f"""
select c.* exclude (NDC, OPIOID_LA_SA_FLAG), {norm('c.NDC')} as NDC, c.OPIOID_LA_SA_FLAG as OPIOID_ER_LA_FLAG,
       p.PATIENT_ID_REF, p.PATIENT_BRTH_YR, p.PATIENT_GENDER, p.PAT_DX_AVAIL_FLAG,
       case when p.PATIENT_ID_REF is not null then 1 else 0 end as merged_pat_ref,
       d.NDC_CD, d.MKTED_PROD_NM, d.MKTED_PROD_FORMLTN_NM, d.ROUTE_ADM_NM, d.DOSAGE_FORM_NM, d.UNIFM_PROD_NM, d.USC_CD,
       case when d.NDC_CD is not null then 1 else 0 end as merged_prod_ref
from claims_bronze c
left join patient_ref p on c.PATIENT_ID = p.PATIENT_ID_REF
left join product_silver d on {norm('c.NDC')} = d.NDC_CD
where c.PROVIDER_SPCL_CD is distinct from 'VET'
  and (c.PROVIDER_STATE in ({STATES}) or c.PROVIDER_STATE is null)""",
}

DEPENDS = {
    "manifest_raw": ["claims", "patient_ref", "product_ref"],
    "product_silver": ["product_ref"],
    "claims_bronze": ["claims"],
    "claims_text": ["claims"],
    "silver": ["claims_bronze", "patient_ref", "product_silver"],
}

_ORDER = ["claims", "patient_ref", "product_ref", "benzo_def", "opioid_def", "mme", "manifest_raw",
          "product_silver", "claims_bronze", "claims_text", "silver"]


def with_views(body: str, *names: str) -> str:
    """``WITH`` the named views (and what they depend on) in front of ``body``."""
    need: set[str] = set()

    def add(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in DEPENDS.get(n, []):
            add(d)

    for n in names:
        add(n)
    ctes = [f"{n} as ({VIEW_SQL.get(n) or DERIVED_SQL[n]})" for n in _ORDER if n in need]
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body
