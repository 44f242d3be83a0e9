"""Every query agrees with its SQL on the smallest tables."""

import math

import duckdb
import pytest

from tallyplane.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else str(round(v, 6) + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_agrees(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    q = duck.execute(catalog.oracle_sql()[name])
    have = [x[0] for x in q.description]
    assert sorted(have) == cols
    want = sorted(tuple(plain(r[have.index(c)]) for c in cols) for r in q.fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_matching_queries_take_every_row(spark, sf, monkeypatch):
    seen = {}
    monkeypatch.setattr(catalog.M, "match", lambda left, right, *a: seen.update(parts=left.count() + right.count()))
    monkeypatch.setattr(catalog.M, "assign_greedily", lambda scores, by, c, r, score, m: seen.update(quantity=scores.agg({score: "sum"}).first()[0]))
    catalog.queries()["least_cost_matching"](spark, sf)
    catalog.queries()["greedy_assignment"](spark, sf)
    assert seen["parts"] == spark.read.parquet(f"{sf}/part.parquet").count()
    assert round(seen["quantity"], 3) == round(spark.read.parquet(f"{sf}/lineitem.parquet").agg({"l_quantity": "sum"}).first()[0], 3)
