"""Every query with a SQL twin gives the twin's rows on the small tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from pricegrid.catalog import registry

TWINS = registry.TWINS
QUERIES = registry.QUERIES


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for f in pathlib.Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def text(value):
    if value is None or value != value:
        return "-"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(text(x) for x in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(name, spark, small, db):
    got = QUERIES[name](spark, small).toPandas()
    want = db.execute(TWINS[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_own_names_are_apart_from_optional_parts():
    assert not [n for n in registry.QUERIES if n == "pipeline" or n.startswith("op")]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
