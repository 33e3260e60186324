"""Every registered query against its SQL, and the shape of every plan."""

import math
import os

import duckdb
import pytest
from conftest import SMALL
from test_similarity import all_pairs

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SMALL}/{file}'")
    return connection


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "null" if math.isnan(v) else f"{v:.9g}"
        return "null" if v is None else str(v)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    found = sql.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert normal(df.columns, df.collect()) == normal(columns, found.fetchall())


def test_every_sql_has_a_query():
    assert set(contract.queries()) - set(contract.CORPUS_QUERIES) <= set(contract.oracle_sql())


def test_fuzzy_urls_equal_all_pairs(spark):
    got = contract.queries()["fuzzy_urls"](spark, SMALL).collect()
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    names = list(dict.fromkeys(p.url for p in sorted(pages)))
    want = {(names[a], names[b], s) for a, b, s in all_pairs(names)}
    assert {(r.name_a, r.name_b, r.score) for r in got} == want
    assert len(got) == len(want)


def test_entry(spark):
    (row,) = contract.entry(spark).collect()
    assert row.status == "SUCCESS" and row.orphan_ids == 0
