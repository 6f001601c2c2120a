"""Gap filling, greedy merging, samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import text as T
from lectern.operators import sequence as S
from lectern.plans.inputs import SEGMENTS_SQL, read, segments, timeline
from lectern.plans.registry import query
from lectern.plans.text_queries import STORE_SQL

GAP_SQL = """WITH t AS (SELECT user_id AS src, ts, event_id, CASE WHEN event_type <> 'error' THEN epoch_us(ts) / 1e6 END AS s, CASE WHEN event_type <> 'error' THEN epoch_us(ts) / 1e6 + value END AS e FROM events),
n AS (SELECT src, event_id, coalesce(s, last_value(e IGNORE NULLS) OVER (PARTITION BY src ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS s,
coalesce(e, first_value(s IGNORE NULLS) OVER (PARTITION BY src ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS e FROM t)
SELECT src, event_id, round(CASE WHEN s IS NULL AND e IS NOT NULL THEN greatest(0, e - 10) ELSE s END, 3) AS filled_start, round(CASE WHEN e IS NULL AND s IS NOT NULL THEN s + 10 ELSE e END, 3) AS filled_end FROM n"""


@query(GAP_SQL)
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events are one contiguous run, as the file order is by user and time."""
    out = S.gap_fill(timeline(spark, sf_dir), ["src"], "line")
    return out.select("src", "event_id", F.round("filled_start", 3).alias("filled_start"), F.round("filled_end", 3).alias("filled_end"))


@query("SELECT user_id, event_id, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT user_id, event_id, ts, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> event_type THEN 1 ELSE 0 END AS c FROM events)")
def contiguous_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("line"))
    return S.contiguous_runs(rows, "event_type", "line", ["user_id"]).select("user_id", "event_id", F.col("run").cast("long").alias("run"))


@query("SELECT event_id, round(greatest(0, epoch_us(ts) / 1e6 - 1.5), 3) AS low, round(epoch_us(ts) / 1e6 + value + 1.5, 3) AS high FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_type = 'error'")
def padded_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = S.padded_view(F.col("start"), F.col("end"), 1.5)
    return timeline(spark, sf_dir).select("event_id", F.round(low, 3).alias("low"), F.round(high, 3).alias("high"))


MERGE_SQL = rf"""WITH RECURSIVE s AS (SELECT prefix, seg, duration AS d, text AS t, regexp_matches(regexp_replace(text, '^\s+|\s+$', '', 'g'), '[.!?…]+["'')\]]*$') AS b, row_number() OVER (PARTITION BY prefix ORDER BY seg) AS i FROM ({SEGMENTS_SQL})),
f AS (SELECT prefix, i, 0 AS chunk, seg AS first, seg AS last, 1 AS n, d AS duration, t AS text, (d >= 1.6 AND length(trim(t)) >= 10 AND d >= 2.5 AND b) AS closed FROM s WHERE i = 1
UNION ALL SELECT prefix, next, CASE WHEN j THEN chunk ELSE chunk + 1 END, CASE WHEN j THEN first ELSE seg END, seg, CASE WHEN j THEN n + 1 ELSE 1 END, CASE WHEN j THEN duration + d ELSE d END, CASE WHEN j THEN text || ' ' || t ELSE t END,
CASE WHEN j THEN duration + d >= 2.5 AND length(trim(text || ' ' || t)) >= 10 AND b ELSE d >= 2.5 AND length(trim(t)) >= 10 AND b END
FROM (SELECT f.*, s.seg, s.d, s.t, s.b, s.i AS next, NOT f.closed AND f.duration + s.d <= 15 AS j FROM f JOIN s ON s.prefix = f.prefix AND s.i = f.i + 1)),
c AS (SELECT prefix, chunk, arg_max(first, i) AS first, max(last) AS last, max(n) AS n, arg_max(duration, i) AS duration, arg_max(text, i) AS text FROM f GROUP BY prefix, chunk),
k AS (SELECT prefix, row_number() OVER (PARTITION BY prefix ORDER BY chunk) - 1 AS chunk, first, last, n, duration, text FROM (SELECT * REPLACE ({STORE_SQL} AS text) FROM c) WHERE text <> ''),
z AS (SELECT *, max(chunk) OVER (PARTITION BY prefix) AS top FROM k),
y AS (SELECT *, lead(n) OVER w AS n2, lead(last) OVER w AS last2, lead(duration) OVER w AS d2, lead(text) OVER w AS t2 FROM z WINDOW w AS (PARTITION BY prefix ORDER BY chunk)),
x AS (SELECT *, chunk = top AND top > 0 AND (duration < 1.6 OR length(text) < 10) AS gone, chunk = top - 1 AND (d2 < 1.6 OR length(t2) < 10) AS takes FROM y)
SELECT prefix, CAST(chunk AS INTEGER) AS chunk, first, CASE WHEN takes THEN last2 ELSE last END AS last, CAST(CASE WHEN takes THEN n + n2 ELSE n END AS INTEGER) AS n, round(CASE WHEN takes THEN duration + d2 ELSE duration END, 6) AS duration, CASE WHEN takes THEN text || ' ' || t2 ELSE text END AS text FROM x WHERE NOT gone"""


@query(MERGE_SQL)
def greedy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segments(spark, sf_dir).withColumn("ends", T.is_boundary("text"))
    out = S.greedy_merge(rows, "prefix", "seg", "duration", "text", "ends")
    return out.withColumn("duration", F.round("duration", 6))


#: The hash that stands for the seeded shuffle has no equal in SQL elsewhere.
@query()
def sample_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.seeded_sample(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 100, 42)


@query()
def split_train_test_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_sizes(read(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("SELECT CASE WHEN r <= n // 10 THEN 'val' WHEN r <= n // 10 + 5 THEN 'test' ELSE 'train' END AS part, count(*) AS n_rows FROM (SELECT row_number() OVER () AS r, count(*) OVER () AS n FROM documents) GROUP BY 1")
def split_part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_sizes(read(spark, sf_dir, "documents").select("doc_id"), "doc_id").groupBy("part").agg(F.count("*").alias("n_rows"))
