"""Incremental loading as a Structured Streaming query.

New claims files land in a folder (one delivery at a time). Each micro-batch
is cleaned with the batch functions (lookup joins, filters, NDC repair),
split into markets and merged into the gold tables by key. A micro-batch done
again after a failure (the ``foreachBatch`` recovery contract) leaves the same
tables: merged rows replace themselves, and rows with a NULL in their key lie in
folders of their micro-batch. With ``p.latest`` the same claim may come in several
files and in any order; ``on_duplicate="error"`` raises on a key that comes twice
in a batch. Lookups are static DataFrames joined to each micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from claimlake import schemas
from claimlake.operators import curate
from claimlake.operators.clean import cast_types
from claimlake.plans.jobs import RunParams, write_markets
from claimlake.session import materialize


def claims_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                  as_text: bool = False) -> DataFrame:
    """Streaming read of delivered claims Parquet files with a fixed bronze
    schema; ``as_text`` for deliveries that store every column as a string
    (malformed values become NULL)."""
    reader = spark.readStream.schema(schemas.CLAIMS_TEXT_SCHEMA if as_text else schemas.CLAIMS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return cast_types(reader.parquet(landing), {"YEAR": "int", "ingestion_date": "date"})  # the rest is cast in cleaning


def upsert_batch(batch: DataFrame, patients: DataFrame, products: DataFrame, benzo_def: DataFrame,
                 opioid_def: DataFrame, mme: DataFrame, p: RunParams, run: str | None = None) -> None:
    """One delivery: silver cleaning, then all gold tables and the quarantine in
    one routed write, as in a batch run. ``run`` names the delivery."""
    silver = curate.claims_silver(batch, patients, products, broadcast_max_rows=p.broadcast_max_rows,
                                  on_duplicate=p.lookup_duplicates)
    # Stored once in the shared folder: every market reads its claims from there
    # instead of joining the batch again (and a retry restarts from the files). By market
    # within each file: a market's read skips the other markets' pages.
    staged = materialize(silver.sortWithinPartitions("MARKET_NAME"), "stream-batch")
    write_markets(batch.sparkSession, staged, benzo_def, opioid_def, mme, p, run)


def start(spark: SparkSession, landing: str, checkpoint: str, patients: DataFrame, products: DataFrame,
          benzo_def: DataFrame, opioid_def: DataFrame, mme: DataFrame, p: RunParams,
          available_now: bool = True, max_files_per_trigger: int | None = None, as_text: bool = False) -> StreamingQuery:
    """Start the incremental load. ``available_now`` processes what has
    landed and stops (a scheduled run); otherwise it keeps running. The
    static lookups are stored once, so every micro-batch reads them instead
    of recomputing them."""
    patients, products, benzo_def, opioid_def, mme = (
        materialize(df, "stream-lookup") for df in (patients, products, benzo_def, opioid_def, mme))
    stream = claims_stream(spark, landing, max_files_per_trigger, as_text)
    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, n: upsert_batch(df, patients, products, benzo_def, opioid_def, mme, p, f"{checkpoint}/{n}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
