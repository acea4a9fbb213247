"""Every query outside the corpus operators, beside its SQL in DuckDB, on the smallest tables."""

import decimal
import math

import duckdb
import pytest

from gleaner.plans import analysis_queries, more_queries, queries, static_queries  # noqa: F401  they register their queries

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    found = queries.QUERIES[name](spark, SF)
    got = rows_of(found.columns, found.collect())
    if name not in queries.ORACLE_SQL:  # greedy selections, which other tests hold against a visit one by one
        assert name in ("diversity_shortlist", "near_duplicates", "shortlist_distribution") and (got or name == "near_duplicates")
        return
    wanted = oracle.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    assert got == rows_of(columns, wanted.fetchall())
