"""The registered queries against their SQL on the smallest tables; ``check_oracle.py`` takes any."""

import os

import pytest

import __spark_entry__ as entry
from cashtide.plans import oracle
from cashtide.plans.queries import registered
from check_oracle import TABLES, rows_of

DATA = entry.SMOKE_DIR


# Long streams are compared in tests/test_streaming.py, at their own sizes.
COMPARED = [n for n in sorted(registered()) if n not in ("stream_dedup_ttl", "run_stream", "stream_batch_metrics", "compact_partitions")]


def test_every_query_has_sql():
    assert registered().keys() == oracle.statements().keys()
    assert registered().keys() <= entry.queries().keys()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")
@pytest.mark.parametrize("name", COMPARED)
def test_same_rows_as_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = entry.queries()[name](spark, DATA)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")
def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 5 and rows[0].mentions >= rows[-1].mentions
