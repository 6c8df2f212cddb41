"""Every query against the same question asked in SQL, over all rows of the sf0.01 tables."""

import math
from pathlib import Path

import duckdb
import pytest

from daytally.plans.oracle import ORACLE
from daytally.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(row[i]) for i in order) for row in rows)


def _kind(type_name: str) -> str:
    name = type_name.lower()
    if name in ("bigint", "hugeint", "integer", "int"):
        return "integer"
    return {"varchar": "string"}.get(name, name)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    wanted_columns = [d[0] for d in cursor.description]
    wanted_kinds = {d[0]: _kind(str(d[1])) for d in cursor.description}
    assert sorted(found.columns) == sorted(wanted_columns)
    assert {n: _kind(t) for n, t in found.dtypes} == wanted_kinds
    wanted = _rows(wanted_columns, cursor.fetchall())
    got = _rows(found.columns, found.collect())
    assert len(got) == len(wanted)
    assert got == wanted


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
