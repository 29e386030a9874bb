"""Every registered query against its SQL, on all rows and all columns."""

import duckdb
import pytest

import __spark_entry__ as driver
from claimweave.plans import oracle, registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Cartesian", "NestedLoop", "EvalPython", "MapInPandas"):
        assert unwanted not in plan
    cursor = duck.execute(oracle.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(types) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    actual = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    expected = [tuple(r[order.index(c)] for c in columns) for r in expected]
    assert actual
    assert sorted(actual, key=repr) == sorted(expected, key=repr)


def test_numbers_from_values_that_are_not_finite(spark, tmp_path):
    """Both engines read the same text out of a value, also where each spells it in its own way."""
    values = "unnest(['nan', 'inf', '-inf', '-0.0', '1e-7', '1e22', '2.5', null]::double[]) as value"
    made = f"select k * 23 + 15 + j as event_id, {values}, timestamp '2024-01-01' as ts from range(3) a(k), range(3) b(j)"
    duckdb.sql(f"copy ({made}) to '{tmp_path}/events.parquet'")
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    expected = connection.execute(oracle.oracle_sql()["clean_numbers"]).fetchall()
    actual = [tuple(r) for r in registry.queries()["clean_numbers"](spark, str(tmp_path)).collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr) and len(actual) == 72
