"""Queries against their SQL: on the smallest tables and on awkward rows."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import Row

from claimlake.llm import queries
from tests.conftest import SF_SMALL
from tests.llm import edge


def assert_equals_sql(spark, name: str, path: str, table: str) -> None:
    con = duckdb.connect()
    place = f"{path}/{table}.parquet"
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{place}{'' if path == SF_SMALL else '/*.parquet'}')")
    got = queries.QUERIES[name](spark, path)
    want = con.sql(queries.ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(str(Row(**dict(zip(columns, r, strict=True)))) for r in want.select(*columns).fetchall())


@pytest.mark.parametrize("name", [n for n in ("op3_block_max_search", "op9_secret_index", "op10_minhash_groups") if n in queries.ORACLE])
def test_documents(spark, name):
    assert_equals_sql(spark, name, SF_SMALL, "documents")


def test_preferences(spark):
    assert_equals_sql(spark, "op5_preference_format", SF_SMALL, "conversations")


def test_preferences_in_several_pools_and_awkward_turns(spark, tmp_path):
    r = random.Random(1)
    rows = [(c, t, r.choice(["user", "assistant", "system", None]), r.choice(["", None, "yes", "näh\U0001f600", f"t{r.randint(0, 9)}"])) for c in range(-150, 150) for t in range(r.randint(0, 5))]
    rows += [(200, None, "assistant", "first"), (200, 1, "assistant", "b"), (200, 1, "assistant", "a"), (None, 1, "assistant", "lost")] + rows[:20]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert_equals_sql(spark, "op5_preference_format", str(tmp_path), "conversations")


def test_secrets_on_awkward_rows(spark, tmp_path):
    more = ["paſſword=abcdefgh toKen=abcdefgh", "TOKEN:\x20\x20'aaaaaa' apikey=\x0bbbbbbb api_key=12345", "AKIA" + "A" * 15 + " AKIAAKIA" + "B" * 16,
            "\U0001f600secret='xxxxxx'secret=yyyyyyy", "-----BEGIN RSA PRIVATE KEY-----\x0b\nab=\n-----END RSA PRIVATE KEY-----x", "ftp://a:bcd@e.f ftp://a\x0b:bcd@e"]
    df = spark.createDataFrame(edge.rows([*edge.TEXTS, *[(100 + i, t) for i, t in enumerate(more)]]), edge.SCHEMA)
    assert_equals_sql(spark, "op9_secret_index", edge.write(spark, df, tmp_path), "documents")


def test_groups_on_awkward_rows(spark, tmp_path):
    seen, texts = set(), []
    for i, t in edge.TEXTS:  # a row of every id
        if i is not None and i not in seen:
            seen.add(i)
            texts.append((i, t))
    words = edge.prose(7, 60).split()
    texts += [(200 + i, " ".join([*words[: 50 - i], *[f"w{i}x{k}" for k in range(i)], *words[50 - i :]])) for i in range(20)]  # chains around the threshold
    df = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    assert_equals_sql(spark, "op10_minhash_groups", edge.write(spark, df, tmp_path), "documents")
