"""Every registered query against its SQL on the smallest driver tables."""

import math
from pathlib import Path

import duckdb
import pytest

from lectern.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(cell(y) for y in x)
    return x


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if (Path(sf_dir) / f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = as_rows(df.columns, df.collect())
    rel = duck.execute(ORACLES[name])
    want = as_rows([d[0] for d in rel.description], rel.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in rel.description)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).limit(5).collect()
