"""Market rules: silver claims -> the eleven gold market frames.

Every function is DataFrame -> DataFrame; writing is left to
``claimlake.operators.upsert``. All lookups (market definitions, MME) are
joined by broadcast only after a size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.operators.clean import conform, stamp, upper_columns
from claimlake.operators.relate import (
    DEFAULT_BROADCAST_MAX_ROWS,
    assert_unique,
    bounded_broadcast,
    left_join_flag,
)


def _mapped(c: Column, mapping: dict[str, str]) -> Column:
    """Fixed code -> name lookup as a CASE expression (NULL when unmapped)."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def benzo_flag(benzo_def: DataFrame) -> DataFrame:
    """NDC -> BENZO_FLAG: B for BENZODIAZEPINES, OS for OTHER, else NULL."""
    return benzo_def.withColumn(
        "BENZO_FLAG", _mapped(F.col("PROD_CUSTOM_LVL1_DESC"), schemas.BENZO_DESC_TO_CODE))


def opioid_rule(opioid_def: DataFrame) -> DataFrame:
    """Market definition + MARKET_NAME and MOUD.

    BU when USC_CD is 78340 and GPI_DESC differs from the methadone
    concentrate, else O (a NULL GPI_DESC or USC_CD gives O: ``!=`` on NULL is
    not true). MOUD is 1 exactly when USC_CD is 78340.
    """
    usc, gpi = F.col("USC_CD"), F.col("GPI_DESC")
    bu = (usc == schemas.MOUD_USC_CD) & (gpi != schemas.METHADONE_GPI_DESC)
    return opioid_def.withColumns({
        "MARKET_NAME": F.when(bu, F.lit("BU")).otherwise(F.lit(schemas.OPIOID_CODE)),
        "MOUD": F.when(usc == schemas.MOUD_USC_CD, F.lit(1)).otherwise(F.lit(0)),
    })


def gold_input(silver: DataFrame) -> DataFrame:
    """Silver claims with upper-case names (the gold naming)."""
    return upper_columns(silver)


def non_opioid_gold(claims: DataFrame, run_date: str | None = None) -> DataFrame:
    """Additional-market claims (A G M P S T) with their gold table name in
    ``GOLD_TABLE``; other market codes are left out."""
    codes = list(schemas.NON_OPIOID_MARKETS)
    df = conform(claims.where(F.col("MARKET_NAME").isin(codes)), schemas.NON_OPIOID_GOLD_COLUMNS)
    return stamp(df, run_date).withColumn("GOLD_TABLE", _mapped(F.col("MARKET_NAME"), schemas.NON_OPIOID_MARKETS))


def naloxone_gold(claims: DataFrame, run_date: str | None = None) -> DataFrame:
    df = conform(claims.where(F.col("MARKET_NAME") == schemas.NALOXONE_CODE), schemas.OPIOID_FILE_GOLD_COLUMNS)
    return stamp(df, run_date).withColumn("GOLD_TABLE", F.lit("naloxone"))


def benzo_split(claims: DataFrame, benzo_def: DataFrame,
                broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                on_duplicate: str = "keep") -> DataFrame:
    """Market B claims re-labelled B / OS from the market definition; NULL
    where the NDC is unknown or unspecified (``merged`` says whether the
    definition had a flag for it)."""
    flags = assert_unique(benzo_flag(benzo_def).select("NDC", "BENZO_FLAG"), ["NDC"], on_duplicate)
    b = claims.where(F.col("MARKET_NAME") == schemas.BENZO_CODE).drop("MARKET_NAME")
    j = left_join_flag(b, flags, "NDC", flag="merged", flag_from="BENZO_FLAG",
                       broadcast_max_rows=broadcast_max_rows)
    return j.withColumnRenamed("BENZO_FLAG", "MARKET_NAME")


def benzo_gold(split: DataFrame, run_date: str | None = None) -> DataFrame:
    """benzodiazepines + other_sedatives rows (GOLD_TABLE says which);
    rows without a flag are not included (see :func:`unrouted`)."""
    df = conform(split.where(F.col("MARKET_NAME").isNotNull()), schemas.OPIOID_FILE_GOLD_COLUMNS)
    return stamp(df, run_date).withColumn("GOLD_TABLE", _mapped(F.col("MARKET_NAME"), schemas.BENZO_MARKETS))


def mme_enrich(claims: DataFrame, mme: DataFrame,
               broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
               on_duplicate: str = "keep") -> DataFrame:
    """Market O claims with the MME attributes of their NDC (left join) and a
    MERGED 0/1 column; names upper-cased."""
    ref = assert_unique(mme.drop("NDC_Numeric"), ["NDC"], on_duplicate)
    o = claims.where(F.col("MARKET_NAME") == schemas.OPIOID_CODE).drop("MARKET_NAME")
    j = left_join_flag(o, ref, "NDC", flag="merged", flag_from="PRODNME", broadcast_max_rows=broadcast_max_rows)
    return upper_columns(j)


def unmatched_ndc(enriched: DataFrame) -> DataFrame:
    """NDCs of opioid claims without MME attributes, most frequent first."""
    return (enriched.where(F.col("MERGED") == 0).groupBy("NDC").count()
            .orderBy(F.desc("count"), F.asc_nulls_first("NDC")))


def prepare_rule(opioid_def: DataFrame, broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                 on_duplicate: str = "keep") -> DataFrame:
    """NDC -> MARKET_NAME, MOUD, size-checked for broadcast once so the
    buprenorphine, opioid and quarantine frames can share it."""
    rule = assert_unique(opioid_rule(opioid_def).select("NDC", "MARKET_NAME", "MOUD"), ["NDC"], on_duplicate)
    return bounded_broadcast(rule, broadcast_max_rows)[0]


def _with_rule(enriched: DataFrame, opioid_def: DataFrame, broadcast_max_rows: int | None,
               on_duplicate: str, rule: DataFrame | None) -> DataFrame:
    rule = rule if rule is not None else prepare_rule(opioid_def, broadcast_max_rows, on_duplicate)
    # left join + filter on a right column is an inner join: written as one.
    return enriched.join(rule, "NDC", "inner")


def buprenorphine_gold(enriched: DataFrame, opioid_def: DataFrame, run_date: str | None = None,
                       broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                       on_duplicate: str = "keep", rule: DataFrame | None = None) -> DataFrame:
    df = _with_rule(enriched, opioid_def, broadcast_max_rows, on_duplicate, rule).where(
        F.col("MARKET_NAME") == "BU")
    return stamp(conform(df, schemas.BUPRENORPHINE_GOLD_COLUMNS), run_date).withColumn(
        "GOLD_TABLE", F.lit("buprenorphine"))


def opioid_gold(enriched: DataFrame, opioid_def: DataFrame, run_date: str | None = None,
                broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                on_duplicate: str = "keep", rule: DataFrame | None = None) -> DataFrame:
    df = _with_rule(enriched, opioid_def, broadcast_max_rows, on_duplicate, rule).where(
        F.col("MARKET_NAME") == schemas.OPIOID_CODE)
    return stamp(conform(df, schemas.OPIOID_GOLD_COLUMNS), run_date).withColumn("GOLD_TABLE", F.lit("opioid"))


def unrouted(claims: DataFrame, split: DataFrame, enriched: DataFrame, opioid_def: DataFrame,
             broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS, rule: DataFrame | None = None) -> DataFrame:
    """Claims that reach no gold table, with a REASON: unmapped or NULL market
    code, benzo NDC without a flag, opioid NDC missing in the market
    definition. They go to a quarantine table instead of failing the run."""
    known = list(schemas.NON_OPIOID_MARKETS) + [schemas.NALOXONE_CODE, schemas.BENZO_CODE, schemas.OPIOID_CODE]
    keep = ["CLAIM_ID", "YEAR", "PATIENT_ID", "NDC"]
    bad_market = claims.where(~F.coalesce(F.col("MARKET_NAME").isin(known), F.lit(False))).select(
        *keep, F.col("MARKET_NAME"), F.lit("unmapped_market").alias("REASON"))
    no_flag = split.where(F.col("MARKET_NAME").isNull()).select(
        *keep, F.lit(schemas.BENZO_CODE).alias("MARKET_NAME"), F.lit("no_benzo_flag").alias("REASON"))
    if rule is not None:
        ndcs = rule.select("NDC").where(F.col("NDC").isNotNull())
    else:
        ndcs, _ = bounded_broadcast(opioid_def.select("NDC").where(F.col("NDC").isNotNull()), broadcast_max_rows)
    no_def = enriched.join(ndcs, "NDC", "left_anti").select(
        *keep, F.lit(schemas.OPIOID_CODE).alias("MARKET_NAME"), F.lit("no_market_definition").alias("REASON"))
    return bad_market.unionByName(no_flag).unionByName(no_def)


def routed(claims: DataFrame, benzo_def: DataFrame, opioid_def: DataFrame, mme: DataFrame, run_date: str | None = None,
           broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS, on_duplicate: str = "keep") -> DataFrame:
    """Every claim once, with the gold table that takes it in GOLD_TABLE, or NULL
    and the REASON why none does. The columns are those of all gold tables
    together; a table's rows have NULL in columns it doesn't have. The markets that
    need no lookup are read in one pass, each other market in its own: the market
    definitions decide about the table and the quarantine in the same pass."""
    def shaped(df: DataFrame, columns: list[str], table: Column, reason: str | None = None) -> DataFrame:
        df = conform(df.withColumn("GOLD_TABLE", table), [*columns, "GOLD_TABLE"])
        df = stamp(df, run_date).withColumn("REASON", F.when(F.col("GOLD_TABLE").isNull(), F.lit(reason)))
        want = {f.name: f.dataType for f in [*claims.schema.fields, *mme.schema.fields]}
        lacking = [c for c in schemas.GOLD_STORE_COLUMNS if c not in df.columns]
        return df.withColumns({c: F.lit(None).cast("int" if c == "MOUD" else want[c]) for c in lacking})

    market = F.col("MARKET_NAME")
    plain = claims.where(~F.coalesce(market.isin(schemas.BENZO_CODE, schemas.OPIOID_CODE), F.lit(False)))
    plain = shaped(plain, schemas.OPIOID_FILE_GOLD_COLUMNS, _mapped(market, {**schemas.NON_OPIOID_MARKETS, schemas.NALOXONE_CODE: "naloxone"}), "unmapped_market")
    # of these only naloxone has the columns of the opioid file
    own = [c for c in schemas.OPIOID_FILE_GOLD_COLUMNS if c not in schemas.NON_OPIOID_GOLD_COLUMNS]
    plain = plain.withColumns({c: F.when(market == schemas.NALOXONE_CODE, F.col(c)) for c in own})
    split = benzo_split(claims, benzo_def, broadcast_max_rows, on_duplicate)
    benzo = shaped(split, schemas.OPIOID_FILE_GOLD_COLUMNS, _mapped(market, schemas.BENZO_MARKETS), "no_benzo_flag")
    enriched = mme_enrich(claims, mme, broadcast_max_rows, on_duplicate)
    rule = assert_unique(opioid_rule(opioid_def).select("NDC", "MARKET_NAME", "MOUD"), ["NDC"], on_duplicate)
    ruled = left_join_flag(enriched, rule, "NDC", flag="RULED", flag_from="MARKET_NAME", broadcast_max_rows=broadcast_max_rows)
    opioid = shaped(ruled, schemas.OPIOID_GOLD_COLUMNS, _mapped(market, schemas.OPIOID_MARKETS), "no_market_definition")
    # BU claims have no MOUD column in their table
    opioid = opioid.withColumn("MOUD", F.when(F.col("GOLD_TABLE") != "buprenorphine", F.col("MOUD")))
    out = plain
    # an unrouted claim keeps the market code it came with
    for df, code in ((benzo, schemas.BENZO_CODE), (opioid, schemas.OPIOID_CODE)):
        out = out.unionByName(df.withColumn("MARKET_NAME", F.coalesce("MARKET_NAME", F.lit(code))))
    return out.select(*schemas.GOLD_STORE_COLUMNS, "GOLD_TABLE", "REASON")


__all__ = [
    "benzo_flag", "opioid_rule", "gold_input", "non_opioid_gold", "naloxone_gold", "benzo_split",
    "benzo_gold", "mme_enrich", "unmatched_ndc", "prepare_rule", "buprenorphine_gold", "opioid_gold", "unrouted", "routed",
]
