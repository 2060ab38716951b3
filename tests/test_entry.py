"""The contract, and a sample of queries against their oracle SQL. All of them:
python check.py <sf_dir>."""

import duckdb
import pytest

import __spark_entry__ as registry
import check

SAMPLE = (
    "a4_sentiment_by_confidence_range",
    "a17_ingestion_stats",
    "a22_batched_evaluation",
    "a23_comprehensive_report",
    "o2_preprocess_v2",
    "p23_encode_tokens",
    "s1_jsonl_scan",
    "s5_bare_text_scan",
    "s10_flatten_thread",
    "s11_parse_permalink",
    "t4_select_best_run",
    "u5_fallback_cascade",
)


@pytest.fixture(scope="module")
def connection(small):
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    return connection


def test_oracles_belong_to_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"sentiment", "confidence_range", "count"}


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, small, connection, name):
    _, outcome = check.check(spark, name, small, connection)
    assert outcome.startswith("ok"), outcome


def test_every_oracle_runs(connection):
    for name, sql in registry.oracle_sql().items():
        connection.sql(sql).fetchall()
