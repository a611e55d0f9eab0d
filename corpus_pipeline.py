"""Documents to packed training sequences in five stages.

Every stage takes (spark, docs, sf_dir), calls one operator of ``claimlake.llm``
on all documents that the stage before has kept, and returns a DataFrame; all
but the last return the columns of ``documents``. ``run`` writes each stage's
rows as Parquet to the shared folder and reads them back for the next one, so
that a lost executor repeats no earlier stage.

Defined results: a null text has no language and goes in the first stage; rows
with a null id go through all stages and are never near duplicates; rows of
equal id and text become one in the third stage, and different texts of one id
are documents of their own there; an empty table gives an empty result; further
columns of ``documents`` are carried to the last stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import langid, linededup, neardup, packing, secrets
from claimlake.session import materialize

#: The share of near duplicates, held against lines.
COPIED_PERCENT = 80
#: The length above which a repeated passage counts as copied.
COPIED_WORDS = 50


def _with_length(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``n_chars`` follows the text where a stage has changed it."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    length = F.length("text").cast(kind)
    return docs.withColumn("n_chars", length if changed is None else F.when(changed, length).otherwise(F.col("n_chars")))


def _own_names(stage: Callable) -> Callable:
    """Columns that a stage doesn't know go through it under neutral names, so
    that none clashes with a column that an operator adds."""

    @functools.wraps(stage)
    def guarded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        neutral = [c if c in ("doc_id", "text", "lang", "n_chars") else f"column_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*neutral), sf_dir).toDF(*docs.columns)

    return guarded


@_own_names
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language: null, without a letter, or ambiguous (the
    two nearest languages' distances are within a margin, whatever their number).
    Where no row has a language to learn from, every text with a letter stays."""
    model = langid.fit(langid.labelled(docs))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs, model, keep=docs.columns)
    rejected = (F.col("lang_pred") == langid.UNKNOWN) | F.col("ambiguous")
    return found.where(~rejected).select(docs.columns)


@_own_names
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out; a document with nothing left goes. One that has lost
    more than ``COPIED_WORDS`` words to earlier documents, and ``COPIED_PERCENT`` or
    more of all, is a copy and goes whole, so that none is left as a fragment.
    Repeats of a document's own lines don't count for that, and a short text under a
    shared header stays."""
    found = linededup.dedup_lines(docs, least_words=1, count_words=True)
    left, elsewhere = F.col("n_words_left"), F.col("n_words_elsewhere")
    emptied = (left == 0) | ((elsewhere > COPIED_WORDS) & (100 * elsewhere >= COPIED_PERCENT * (left + elsewhere)))
    copied = (F.col("n_removed") > 0) & emptied
    return _with_length(found.where(~copied), F.col("n_removed") > 0).select(docs.columns)


@_own_names
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each near-duplicate group (five-word shingles, 0.8).
    Different texts of one id are compared and kept each by itself."""
    named = docs.where("doc_id IS NOT NULL")
    h = F.xxhash64("text")
    several = named.groupBy("doc_id").agg(F.min(h).alias("x"), F.max(h).alias("y")).where("x <> y")
    # an id with one text is key enough; both keys have the same order then
    named = named.withColumn("key", F.col("doc_id") if several.isEmpty() else F.struct("doc_id", h.alias("h")))
    kept = neardup.groups(named, k=5, percent=80, id_col="key").where("kept").select("key").distinct()
    one = named.join(kept, "key", "left_semi").dropDuplicates(["doc_id", "text"])
    return one.select(docs.columns).unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


@_own_names
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    found = secrets.redact(secrets.scan(docs, keep=docs.columns))
    return _with_length(found, F.size("spans") > 0).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024."""
    import public_tokenizers

    vocabulary, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(packing.pieces(docs, vocabulary, ranks))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("pack", pack),
]

#: Trained models, edit distances, similarities and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline", name)
    return docs
