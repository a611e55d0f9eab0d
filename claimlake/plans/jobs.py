"""End-to-end jobs: manifest, lookups, silver claims, gold markets, exports.

Each job takes plain arguments (a ``RunParams``) instead of notebook
widgets, reads its inputs once, writes once, and returns its reports as
DataFrames (small aggregates) so callers decide what to show or store.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.functions.codes import null_label
from claimlake.operators import colocate, curate, markets, quality, relate, stats
from claimlake.operators.clean import rejected_cells
from claimlake.operators.store import merge_into, read_store
from claimlake.session import materialize
from claimlake.sources import io


@dataclass
class RunParams:
    """What a run works on. ``year=None`` processes every year present in the
    claims. ``delivery`` names the delivered dataset; manifests, lookups, silver
    and quarantine are kept apart by it ("" for a single one).
    ``on_duplicate`` holds for lookups and
    merges; ``latest`` names the column that decides between versions of a claim
    where it is "latest". ``buckets`` shapes gold and quarantine when they are first made.
    A ``strict`` run writes nothing if a check of severity error fails."""

    base: str
    year: int | None = None
    run_date: str | None = None
    on_duplicate: str = "error"
    broadcast_max_rows: int | None = 2_000_000
    quantile_method: str = "exact"
    delivery: str = ""
    latest: str | None = None
    buckets: int | None = None
    strict: bool = False

    @property
    def version(self) -> str | None:
        return self.latest if self.on_duplicate == "latest" else None

    @property
    def lookup_duplicates(self) -> str:
        """Lookups have no column that says which row is latest."""
        return "error" if self.on_duplicate == "latest" else self.on_duplicate

    def named(self, dataset: str) -> str:
        return f"{self.delivery}/{dataset}" if self.delivery else dataset


def _year(df: DataFrame, year: int | None) -> DataFrame:
    return df.where(F.col("YEAR") == year) if year is not None else df


def manifest_job(spark: SparkSession, raw: DataFrame, p: RunParams, dataset: str = "manifest") -> DataFrame:
    """L1: parse the raw manifest and store it (small: one row per delivered file)."""
    parsed = io.parse_manifest(raw, count_col=raw.columns[1])
    path = f"{p.base.rstrip('/')}/bronze/{p.named(dataset)}" + (f"/YEAR={p.year}" if p.year is not None else "")
    parsed.write.mode("overwrite").parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)


def _store_lookup(ref: DataFrame, p: RunParams, dataset: str) -> None:
    """A year's lookup replaces that year's only; without a year it is one
    table without YEAR, which holds for claims of every year."""
    if p.year is not None:
        io.write_year(ref.withColumn("YEAR", F.lit(p.year).cast("int")), p.base, "silver", p.named(dataset), years=[p.year])
    else:
        ref.hint("rebalance").write.mode("overwrite").parquet(io.layer_path(p.base, "silver", p.named(dataset)))


def _typed(df: DataFrame, names: list[str]) -> dict[str, str]:
    """Expected columns with the types they are delivered in (deliveries fix names, not types)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return {c: have.get(c, "string") for c in names}


def lookup_reports(df: DataFrame, key: str, manifest: DataFrame | None, data_type: str) -> dict[str, DataFrame]:
    out = {
        "key_profile": quality.key_profile(df, key),
        "missing": quality.missing_counts(df, long=True),
    }
    if manifest is not None:
        out["row_count"] = quality.row_count_check(df, manifest, data_type)
    return out


def patient_job(spark: SparkSession, bronze: DataFrame, p: RunParams, manifest: DataFrame | None = None,
                dataset: str = "patient_ref") -> dict[str, DataFrame]:
    """L5: canonical patient lookup -> silver, with its checks."""
    ref = curate.patient_lookup(bronze)
    reports = lookup_reports(ref, "PATIENT_ID_REF", manifest, "patient")
    reports["schema"] = quality.schema_diff(ref, _typed(ref, schemas.PATIENT_REF_COLUMNS))
    reports["birth_years"] = quality.frequency(ref, "PATIENT_BRTH_YR")
    reports["genders"] = quality.frequency(ref, "PATIENT_GENDER")
    _store_lookup(ref, p, dataset)
    return reports


def product_job(spark: SparkSession, bronze: DataFrame, p: RunParams, manifest: DataFrame | None = None,
                dataset: str = "product_ref") -> dict[str, DataFrame]:
    """L6: repaired, de-duplicated product lookup -> silver, with its checks."""
    widths = {"NDC_CD": schemas.NDC_WIDTH, "USC_CD": schemas.USC_WIDTH}
    ref = curate.product_lookup(bronze)
    reports = {
        "schema": quality.schema_diff(bronze, _typed(bronze, schemas.PRODUCT_REF_COLUMNS)),
        "lengths_before": quality.length_violations(bronze, widths),
        "lengths_after": quality.length_violations(ref, widths),
        "routes": quality.frequency(ref, "ROUTE_ADM_NM", order="count_desc"),
        "dosage_forms": quality.frequency(ref, "DOSAGE_FORM_NM", order="count_desc"),
        "key_profile_before": quality.key_profile(bronze, "NDC_CD"),
    }
    if manifest is not None:
        reports["row_count"] = quality.row_count_check(bronze, manifest, "product")
    _store_lookup(ref, p, dataset)
    return reports


def claims_checks(bronze: DataFrame, rejected: DataFrame) -> DataFrame:
    """The gate of a claims delivery: what must not happen (``error``) and what
    should not (``warning``), from one pass over the claims and one over the rejects."""
    no = lambda c: F.col(c).isNull()
    found = quality.checks(bronze, {
        "claim_without_id": ("error", no("CLAIM_ID"), 0),
        "claim_without_year": ("error", no("YEAR"), 0),
        "claim_without_month": ("warning", no("MONTH_ID"), 0),
        "unmapped_market": ("warning", ~F.coalesce(F.col("MARKET_NAME").isin(schemas.VALUE_DOMAINS["MARKET_NAME"]), F.lit(False)), 0),
        "ndc_not_repairable": ("warning", F.length("NDC") > schemas.NDC_WIDTH + 1, 0),
        "npi_of_other_length": ("warning", F.length("NPI") != schemas.NPI_WIDTH, 0),
    })
    return found.unionByName(quality.checks(rejected, {"malformed_value": ("error", F.lit(True), 0)}))


def claims_report(bronze: DataFrame, enriched: DataFrame) -> DataFrame:
    """(section, value, count): the counts of the claims report in long form, one
    pass over the delivery and one over the joined claims."""
    state = F.col("PROVIDER_STATE")
    delivered = quality.frequencies(bronze, {
        "missing_month": F.col("MONTH_ID").isNull(),
        "specialty": null_label("PROVIDER_SPCL_CD", schemas.MISSING_LABEL),
        "missing_specialty": F.col("PROVIDER_SPCL_CD").isNull(),
        "missing_state": state.isNull(),
        "excluded_state": F.when(state.isin(schemas.ELIGIBLE_STATES), F.lit("eligible")).otherwise(state),
        "ndc_length": F.length("NDC"),
        "npi_length": F.length("NPI"),
    })
    return delivered.unionByName(quality.frequencies(enriched, {c: F.col(c) for c in ("merged_pat_ref", "merged_prod_ref")}))


def colocate_job(spark: SparkSession, bronze: DataFrame, patients: DataFrame, p: RunParams, buckets: int,
                 dataset: str = "claims") -> tuple[colocate.Colocated, colocate.Colocated]:
    """J1: a delivery's claims and the patient lookup stored by patient in the same
    buckets (more than ``buckets`` if these would be too large). ``claims_job`` takes both in place of the tables, and takes them again
    when it is run again (``colocate.read``), without a shuffle of the claims."""
    also = ["YEAR"] if "YEAR" in patients.columns else []
    ref = relate.assert_unique(patients, ["PATIENT_ID_REF", *also], p.lookup_duplicates).drop("ingestion_date")
    part, base = f"{p.named(dataset)}_by_patient/{p.year or 'all'}", p.base.rstrip("/")
    stored = colocate.store(_year(bronze, p.year), f"{base}/bronze_{part}", ["PATIENT_ID", *also], buckets)
    return stored, colocate.store(ref, f"{base}/lookup_{part}", ["PATIENT_ID_REF", *also], stored.buckets, lookup=True)


def unmatched_flags(delivery: DataFrame | colocate.Colocated, written: DataFrame, years: list, patients, products, **kw) -> DataFrame:
    """(PATIENT_ID, CLAIM_ID, YEAR, merge flags) of every claim of a delivery. Those that
    silver keeps have their flags there; the others, narrow, are joined for them alone.
    The lookups' keys were checked when silver was written."""
    key, flags = ["PATIENT_ID", "CLAIM_ID", "YEAR"], ["merged_pat_ref", "merged_prod_ref"]
    known = [y for y in years if y is not None]
    here = F.col("YEAR").isin(known) if len(known) == len(years) else F.col("YEAR").isin(known) | F.col("YEAR").isNull()
    out = curate.claims_enrich(delivery.where(curate.left_out()).select(*key, "NDC"), patients, products, **kw)
    return written.where(here).select(*key, *flags).unionByName(out.select(*key, *flags))


def claims_job(spark: SparkSession, bronze: DataFrame | colocate.Colocated, patients: DataFrame | colocate.Colocated, products: DataFrame,
               p: RunParams, manifest: DataFrame | None = None, dataset: str = "claims") -> dict[str, DataFrame]:
    """L7 + L8 + L9: enrich, clean and write silver claims partitioned by
    YEAR and MARKET_NAME (gold jobs then read only their market's folders);
    quality reports are computed from the written table (one read, no
    re-join). The joined table is written once, as silver; both unmatched
    extracts read their flags there and join only the claims that silver drops.
    ``bronze`` and ``patients`` may be what ``colocate_job`` has stored."""
    delivery = bronze if p.year is None else bronze.where(F.col("YEAR") == p.year)
    bronze = delivery.rows() if isinstance(delivery, colocate.Colocated) else delivery
    # Values that the casts would lose: counted before anything is written, kept by year.
    rejected = materialize(rejected_cells(bronze, curate.CLAIMS_CASTS, schemas.UPSERT_KEYS, p.named(dataset)), "rejected")
    kw = {"broadcast_max_rows": p.broadcast_max_rows, "on_duplicate": p.on_duplicate}
    silver = curate.claims_clean(curate.claims_enrich(delivery, patients, products, **kw))
    checked = materialize(claims_checks(bronze, rejected), "checks")
    quality.gate(checked, p.strict)  # nothing is written by a strict run that fails
    dataset = p.named(dataset)
    # a row per year: a year delivered now replaces its silver and its rejects
    years = [r[0] for r in bronze.select("YEAR").distinct().collect()] if p.year is None else [p.year]
    io.write_year(silver, p.base, "silver", dataset, ("MARKET_NAME",), years)
    io.write_year(rejected, p.base, "quarantine", f"{dataset}_rejected", (), years)
    written = io.read_layer(spark, p.base, "silver", dataset, p.year, silver.schema)
    flags = materialize(unmatched_flags(delivery, written, years, patients, products, broadcast_max_rows=p.broadcast_max_rows), "claims-flags")
    lost = {name: flags.where(F.col(flag) == 0).select("PATIENT_ID", "CLAIM_ID", "YEAR")
            for flag, name in (("merged_pat_ref", "patient_notin_ref"), ("merged_prod_ref", "product_notin_ref"))}
    exports = f"{p.base.rstrip('/')}/silver/data_quality_check_exports/{dataset}"
    for name, rows in lost.items():
        io.export_csv(rows, f"{exports}/{name}", ("YEAR",))
    reports = {
        "schema": quality.schema_diff(bronze, _typed(bronze, schemas.CLAIMS_COLUMNS)),
        "pivot": quality.pivot_counts(bronze, ["YEAR", "MONTH_ID"], "MARKET_NAME", sorted(
            list(schemas.NON_OPIOID_MARKETS) + [schemas.BENZO_CODE, schemas.NALOXONE_CODE, schemas.OPIOID_CODE])),
        "unmatched_patients": lost["patient_notin_ref"],
        "unmatched_products": lost["product_notin_ref"],
        "missing": quality.missing_counts(written, long=True),
        "profile": quality.profile(written, {
            "negative_pay": F.col("PATIENT_PAY") < 0,
            "ndc_bad_length": F.length("NDC") != schemas.NDC_WIDTH,
            "npi_bad_length": F.length("NPI") != schemas.NPI_WIDTH,
        }),
    }
    if manifest is not None:
        reports["months"] = quality.reconcile_months(bronze, manifest)
    measures = ("QUANTITY", "PATIENT_PAY", "DAYS_SUPPLY")
    reports["summary"] = stats.robust_summaries(written, measures, "MARKET_NAME", method=p.quantile_method, materialized=True)
    for c in measures:
        reports[f"summary_{c}"] = reports["summary"].where(F.col("measure") == c).drop("measure")
    reports["checks"] = checked
    reports["report"] = claims_report(bronze, flags)
    reports["keys"] = quality.key_profile(bronze, "CLAIM_ID")
    reports["value_domains"] = quality.value_domains(written, schemas.VALUE_DOMAINS)
    reports["rejected"] = rejected.groupBy("YEAR", "column_name").count()
    return reports


def write_markets(spark: SparkSession, silver: DataFrame, benzo_def: DataFrame, opioid_def: DataFrame, mme: DataFrame,
                  p: RunParams, run: str | None = None) -> DataFrame:
    """Routes the claims once, stores them, and merges them into the one table
    that holds all gold tables by (GOLD_TABLE, YEAR, bucket); claims that no
    table takes go to the quarantine table, and those that a table takes now leave
    it. Returns the stored routed claims.

    ``run`` names a delivery (a micro-batch): done again, it replaces the rows
    with NULL keys it added before. With ``p.version`` the order of deliveries doesn't
    matter: of a claim's versions the latest stays in its gold table, and an
    unrouted version stays in quarantine until a version as late is routed."""
    routed = markets.routed(markets.gold_input(silver), benzo_def, opioid_def, mme, p.run_date, p.broadcast_max_rows, p.lookup_duplicates)
    routed = materialize(routed, "routed")
    gold = io.layer_path(p.base, "gold", io.GOLD_DATASET)
    taken = routed.where(F.col("GOLD_TABLE").isNotNull()).drop("REASON")
    merge_into(spark, taken, gold, schemas.UPSERT_KEYS, ("GOLD_TABLE", "YEAR"), p.buckets, p.on_duplicate, p.version, run, staged=True)
    left = routed.where(F.col("GOLD_TABLE").isNull()).select(*schemas.QUARANTINE_COLUMNS)
    if p.version:
        left = not_superseded(spark, left, gold, p.version)
    quarantine = io.layer_path(p.base, "quarantine", p.named("claims_unrouted"))
    # without a run's name the delivery's: a delivery repeated replaces its rows without a key
    merge_into(spark, left, quarantine, schemas.UPSERT_KEYS, ("YEAR",), p.buckets, "latest" if p.version else "keep", p.version,
               run or f"{p.delivery}/{p.year}", gone=taken.select(*schemas.UPSERT_KEYS, *([p.version] if p.version else [])), staged=not p.version)
    return routed


def not_superseded(spark: SparkSession, left: DataFrame, gold: str, latest: str) -> DataFrame:
    """Unrouted claims of which no gold table has a version as late. Gold is read
    in the years of these claims only."""
    years = [r[0] for r in left.select("YEAR").distinct().collect()]  # a row per year
    known = read_store(spark, gold, F.col("YEAR").isin([y for y in years if y is not None]))
    known = known.groupBy(*schemas.UPSERT_KEYS).agg(F.max(latest).alias("__to")).withColumnsRenamed({c: f"__{c}" for c in schemas.UPSERT_KEYS})
    same = (left["CLAIM_ID"] == known["__CLAIM_ID"]) & (left["YEAR"] == known["__YEAR"])
    return left.join(known, same & (left[latest].isNull() | (left[latest] <= known["__to"])), "left_anti")


def gold_job(spark: SparkSession, silver: DataFrame, benzo_def: DataFrame, opioid_def: DataFrame, mme: DataFrame,
             p: RunParams, run: str | None = None) -> dict[str, DataFrame]:
    """L10-L15: every gold table and the quarantine in one routed write; returns
    the opioid NDCs without MME attributes and the yearly totals read back from
    gold (L17)."""
    routed = write_markets(spark, _year(silver, p.year), benzo_def, opioid_def, mme, p, run)
    opioid = routed.where(F.col("GOLD_TABLE").isin(list(schemas.OPIOID_MARKETS.values())) | (F.col("REASON") == "no_market_definition"))
    out = {"unmatched_ndc": markets.unmatched_ndc(opioid.withColumn("MERGED", F.col("PRODNME").isNotNull().cast("int")))}
    io.export_csv(out["unmatched_ndc"], f"{p.base.rstrip('/')}/gold_exports/{p.named('unmatched_ndc')}/run={p.year or 'all'}", ())
    stored = read_store(spark, io.layer_path(p.base, "gold", io.GOLD_DATASET))
    out["year_totals"] = stored.groupBy("GOLD_TABLE", "YEAR").count()
    return out


def read_quarantine(spark: SparkSession, p: RunParams) -> DataFrame:
    """Claims that no gold table has taken, with the reason."""
    return read_store(spark, io.layer_path(p.base, "quarantine", p.named("claims_unrouted")))


def export_job(spark: SparkSession, p: RunParams, sink: str, tables: list[str] | None = None,
               single_file: bool = False, profile: str = "full") -> list[str]:
    """L16: CSV export of gold tables (a year or all), one folder per YEAR;
    years exported before stay. ``profile="without_product"`` leaves the
    product columns out and goes to a path of its own."""
    if profile not in ("full", "without_product"):
        raise ValueError(f"unknown export profile {profile!r}")
    root, drop = (sink.rstrip("/"), []) if profile == "full" else (f"{sink.rstrip('/')}/without_product", schemas.PRODUCT_COLUMNS)
    paths = []
    for table in tables or schemas.GOLD_MARKETS:
        df = io.read_gold(spark, p.base, table, p.year)
        paths.append(io.export_csv(df, f"{root}/{table}", ("YEAR",), single_file, drop))
    return paths


def lookup_export_job(spark: SparkSession, p: RunParams, sink: str, datasets: tuple[str, ...] = ("patient_ref", "product_ref")) -> list[str]:
    """CSV of the stored lookups, one folder per YEAR where they are kept by year."""
    paths = []
    for dataset in datasets:
        df = io.read_layer(spark, p.base, "silver", p.named(dataset), p.year)
        paths.append(io.export_csv(df, f"{sink.rstrip('/')}/{p.named(dataset)}", ("YEAR",) if "YEAR" in df.columns else ()))
    return paths
