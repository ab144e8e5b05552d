"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from millrace.catalog import CATALOG

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Thousands of merges take too long as SQL; test_full_vocabulary compares these with the tokenizers library.
WITHOUT_SQL = {
    "t5_train_bpe_6400", "e1_encode_6400", "pretrain_rows_6400", "sft_rows_6400", "lora_rows_6400", "dpo_rows_6400",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_only_known_queries_have_no_sql():
    assert {name for name, (_, sql) in CATALOG.items() if sql is None} == WITHOUT_SQL


@pytest.mark.parametrize("name", [n for n in CATALOG if n not in WITHOUT_SQL])
def test_query(spark, duck, name):
    query, sql = CATALOG[name]
    got, expected = query(spark, SF_DIR).toPandas(), duck.sql(sql).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    got = got[columns].sort_values(columns).reset_index(drop=True)
    expected = expected[columns].sort_values(columns).reset_index(drop=True)
    assert len(got) == len(expected) > 0
    for column in columns:
        assert (got[column].astype(str) == expected[column].astype(str)).all(), column
