"""Queries held against their SQL on small tables of their own, with what the given ones happen to lack."""

import datetime

import pytest

import __spark_entry__


@pytest.fixture
def agree(spark, tmp_path):
    """Whether a query has its SQL's rows on the given tables, each a list of rows and a schema."""
    import duckdb

    def check(name, **tables):
        own = duckdb.connect()
        for table, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
            own.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        got = __spark_entry__.queries()[name](spark, str(tmp_path))
        want = own.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
        return sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and len(want) > 0

    return check


EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def test_row_patterns_of_logs_without_failures(agree):
    """Users of each remainder, with logs of only passes, only errors, and failures."""
    kinds = [["click"], ["error", "signup"], ["view", "click"], ["purchase"]]
    rows = [(1000 * u + 2 * k + side, datetime.datetime(2024, 1, 1), u, kind, 0.0, "{}") for u in range(28) for side in (0, 1) for k, kind in enumerate(kinds[(u // 7 + side) % 4])]
    assert agree("q_row_patterns", events=(rows, EVENTS))
