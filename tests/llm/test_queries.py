"""Queries with SQL give the SQL's rows; the pipeline's stages chain."""

import pathlib

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from pricegrid.llm import queries


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for f in pathlib.Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows(frame):
    def show(v):
        if hasattr(v, "__len__") and not isinstance(v, str):
            return str([int(x) for x in v])
        return "-" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(show(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(name, spark, small, db):
    got = queries.QUERIES[name](spark, small).toPandas()
    want = db.execute(queries.ORACLES[name]).df()
    want = want.where(want.notna(), None)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_thirteen_operators_and_five_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_keeps_columns_and_only_drops_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        done = corpus_pipeline.staged(stage(spark, docs, small), f"test-{name}")
        now = {r.doc_id for r in done.select("doc_id").collect()}
        assert now and now <= ids
        if name != "mixing":
            assert done.columns == docs.columns
        docs, ids = done, now
    assert docs.where("copies < 1").count() == 0


def test_pipeline_on_odd_rows(spark, small, tmp_path):
    """Nulls, repeated rows, clashing names, and no rows at all."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40)
    for c in ("domain", "tokens", "__id", "__gone", "gone", "d", "p", "id", "leaf", "h", "key"):
        docs = docs.withColumn(c, docs["source"])
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "src1", 0)], docs.schema[:5])
    docs = docs.unionByName(docs.limit(3)).unionByName(odd, allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert set(done.columns) == {*docs.columns, "copies"} and 0 < done.count() <= 45
    docs.where("false").write.mode("overwrite").parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
