"""Every query that has SQL gives the SQL's rows; the others give rows."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lexmill.plans import registry

SF = Path("/root/testdata/sf0.001")
ROWS_ONLY = [q for q in registry.QUERIES if q not in registry.ORACLES]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float | Decimal):
        return "nan" if math.isnan(v) else f"{float(v):.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, duck, name):
    got = entry.queries()[name](spark, str(SF))
    want = duck.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted([plain(r[c]) for c in columns] for r in got.collect()) == sorted([plain(r[k]) for k in at] for r in want.fetchall())


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows(spark, name):
    assert entry.queries()[name](spark, str(SF)).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 40
