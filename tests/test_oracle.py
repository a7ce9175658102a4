"""Every query of the package over whole tables against its SQL."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from quire.plans import registry


def _key(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def test_registered():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_as_sql(spark, data, db, name):
    df = registry.queries()[name](spark, data)
    cols = sorted(df.columns)
    got = Counter(tuple(map(_key, r)) for r in df.select(*cols).collect())
    want = Counter(tuple(map(_key, r)) for r in db.execute(f"select {', '.join(cols)} from ({registry.oracle_sql()[name]})").fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
