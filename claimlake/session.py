"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on; a cluster session normally has them already.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Parquet overwrite of a YEAR-partitioned table only replaces the years written.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Plans are checked by their text: filters must not be cut in it.
    "spark.sql.maxMetadataStringLength": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # RDD checkpoints (quantile state) are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "claimlake") -> SparkSession:
    """Local session for tests and the benchmark (a cluster brings its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only in a local session a scratch folder is made
    when it is unset, so checkpoint() works the same way in tests; a cluster
    without a shared folder is an error, since its machines don't see each
    other's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        root = tempfile.mkdtemp(prefix="claimlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared folder (one per call, never reused)."""
    root = shared_root(spark).rstrip("/")
    return "/".join([root, "claimlake", *parts, uuid.uuid4().hex])


#: Of writes that move or keep whole tables: shuffled rows go when a write ends (they stay until the driver's next
#: garbage collection otherwise), and tasks write up to so many partitions at once without sorting (and spilling) their rows.
SPARING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


@contextmanager
def sparing_disk(spark: SparkSession):
    """The session's settings are ``SPARING`` for the writes inside."""
    before = {k: spark.conf.get(k, None) for k in SPARING}
    for k, v in SPARING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df, *parts: str, partition_by: tuple[str, ...] = (), codec: str | None = None):
    """Write ``df`` as Parquet to a fresh folder under the shared folder and
    read it back: cuts the lineage (a lost executor recomputes from the
    written files, not from the whole upstream plan) and lets several later
    passes read it with column pruning instead of recomputing it. ``codec``:
    of the files, by default the session's."""
    path = shared_path(df.sparkSession, "stage", *parts)
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out.write.mode("overwrite").options(**({"compression": codec} if codec else {})).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

