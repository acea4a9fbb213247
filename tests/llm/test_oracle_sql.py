"""The corpus queries that SQL can state, beside their SQL in DuckDB."""

import duckdb
import pytest

pytest.importorskip("gleaner.llm.queries")
from gleaner.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    wanted = connection.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in wanted.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)

    def plain(rows):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)

    assert plain(map(tuple, found.select(*columns).collect())) == plain(wanted.fetchall())
