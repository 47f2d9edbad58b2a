"""Every query with an oracle gives the DuckDB answer (sf0.001)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as ent

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr), [cols[i] for i in order]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_matches_oracle(spark, sf_dir, duck, name):
    sdf = ent.queries()[name](spark, sf_dir)
    got, gcols = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = duck.execute(ent.oracle_sql()[name])
    want, wcols = _rows([d[0] for d in cur.description], cur.fetchall())
    assert gcols == wcols
    assert got == want


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_entry_runs(spark):
    rows = ent.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["status"] in ("ok", "no_ground_truth_available")
