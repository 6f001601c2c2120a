"""Rounded samples against SQL, down to the sign of zero."""

import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.functions import arrays as A
from lectern.plans.registry import ORACLES, QUERIES


def bits(xs):
    return [struct.pack("<d", x) for x in xs]


@pytest.mark.parametrize("name", ["clip_range", "mono_mix", "peak_normalize"])
def test_small_negative_samples_keep_their_sign(spark, tmp_path, name):
    rows = [(k, [(-1) ** (i + k) * 10.0 ** -(i % 12) * (1 + i / 100) for i in range(64)]) for k in range(4)]
    rows.append((4, [-3e-7 if i % 32 else 0.25 for i in range(64)]))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    column = {"clip_range": "clip", "mono_mix": "mono", "peak_normalize": "audio"}[name]
    want = {k: bits(x) for k, x in con.execute(f"SELECT vec_id, {column} FROM ({ORACLES[name]})").fetchall()}
    assert any(b == bits([-0.0])[0] for x in want.values() for b in x)
    assert {r.vec_id: bits(r[column]) for r in QUERIES[name](spark, str(tmp_path)).collect()} == want


def test_rounded_equals_sql(spark):
    xs = [0.0, -0.0, 4e-7, -4e-7, 5e-7, -5e-7, 1.0000005, -2.5e-6, 0.1234565, 1e300, -1e305, float("inf"), float("-inf"), 7812.5e-6, None]
    got = [r.y for r in spark.createDataFrame(list(enumerate(xs)), "k int, x double").orderBy("k").select(A.rounded(F.col("x"), 6).alias("y")).collect()]
    want = [r[0] for r in duckdb.connect().execute("SELECT round(x, 6) FROM (SELECT unnest(?::DOUBLE[]) AS x)", [xs]).fetchall()]
    assert [x is None for x in got] == [x is None for x in want]
    assert bits(x for x in got if x is not None) == bits(x for x in want if x is not None)
