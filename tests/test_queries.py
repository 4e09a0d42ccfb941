"""Every registered query against its SQL on the driver tables."""

import glob
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from refrain.plans import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark and checking-engine names of the same type.
TYPE_NAMES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def test_contract():
    assert contract.QUERIES.keys() == contract.ORACLE_SQL.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    result = duck.execute(contract.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPE_NAMES[t] for c, t in df.dtypes} == types
    columns = sorted(types)
    place = {c[0]: i for i, c in enumerate(result.description)}
    expected = Counter(
        tuple(plain(r[place[c]]) for c in columns) for r in result.fetchall()
    )
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    assert got, "no rows"
    assert not (got - expected) and not (expected - got), (
        list((got - expected).items())[:3],
        list((expected - got).items())[:3],
    )


def test_files_of_the_stream_grow_in_number_and_not_in_size(spark, sf_dir, monkeypatch):
    asked = {}

    def watched(session, source, *args, files_per_batch):
        asked.update(files=len(glob.glob(source)), files_per_batch=files_per_batch)
        return prepare_stream(session, source, *args, files_per_batch=files_per_batch)

    prepare_stream = queries.prepare_stream
    few = Counter(tuple(r) for r in queries.streamed_batches(spark, sf_dir).collect())
    monkeypatch.setattr(queries, "ROWS_A_FILE", 500)
    monkeypatch.setattr(queries, "prepare_stream", watched)
    many = Counter(tuple(r) for r in queries.streamed_batches(spark, sf_dir).collect())
    n_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert asked == {"files": -(-n_rows // 500), "files_per_batch": -(-n_rows // 1000)}
    assert few == many


def test_raw_items_are_written_by_methods_that_the_jvm_compiles(spark, sf_dir, monkeypatch, tmp_path):
    limits = []
    monkeypatch.setattr(queries, "write_csv", lambda df, path: limits.append(spark.conf.get(queries.METHOD_LIMIT)))
    before = spark.conf.get(queries.METHOD_LIMIT)
    spark.conf.set(queries.METHOD_LIMIT, "65535")
    try:
        queries._raw_csv(spark, sf_dir, str(tmp_path))
        assert limits == ["8000", "8000"]
        assert spark.conf.get(queries.METHOD_LIMIT) == "65535"
    finally:
        spark.conf.set(queries.METHOD_LIMIT, before)
