"""Every registered query with an oracle matches DuckDB at sf0.001 (row count, columns, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_unique_columns():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 55


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(SQL[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    duck = {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: f.dataType.simpleString() for f in sdf.schema.fields} == duck
    assert len(rows) == len(drows)
    assert digest(sdf.columns, rows)[0] == digest(rel.columns, drows)[0]
