"""Aggregates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import text as T
from lectern.operators import aggregates as A
from lectern.operators.rules import overall_verdict
from lectern.functions.udfs import all_long_parts
from lectern.operators.sequence import greedy_pack
from lectern.plans.inputs import ACCENTED, METADATA_SQL, PLAIN, VERDICTS_SQL, metadata, read, verdicts
from lectern.plans.registry import query
from lectern.plans.text_queries import COMPARE_SQL, COUNT_SQL, _cascaded, CASCADE_SQL


@query("SELECT lang, count(n) AS count, CAST(min(n) AS INTEGER) AS min, CAST(max(n) AS INTEGER) AS max, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.95), 6) AS p95 FROM (SELECT lang, length(text) AS n FROM documents) GROUP BY lang")
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("lang", F.length("text").alias("n"))
    out = rows.groupBy("lang").agg(*A.describe("n"))
    return out.select("lang", "count", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p95")])


EDGES = [0.0, 100.0, 500.0, 1000.0, 2000.0, 5000.0, 10000.0]


@query("""WITH b AS (SELECT CAST(i AS INTEGER) AS bin, e[i + 1] AS low, e[i + 2] AS high FROM (SELECT unnest(range(6)) AS i, [0.0::DOUBLE, 100, 500, 1000, 2000, 5000, 10000] AS e)),
c AS (SELECT bin, low, high, (SELECT count(*) FROM documents WHERE length(text) >= low AND (length(text) < high OR bin = 5 AND length(text) <= high)) AS count FROM b)
SELECT bin, low, high, count, repeat('#', CAST(floor(count / (SELECT max(count) FROM c) * 40) AS INTEGER)) AS bar FROM c""")
def length_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.histogram(read(spark, sf_dir, "documents").select(F.length("text").alias("n")), "n", EDGES)


@query(f"SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(min(length(text)) AS INTEGER) AS min_len, round(avg(length(text)), 6) AS mean_len, CAST(max(length(text)) AS INTEGER) AS max_len, count(*) FILTER (a > 0 AND b = 0) AS pure_primary, count(*) FILTER (a > 0 AND b > 0) AS mixed, count(*) FILTER (a = 0 AND b > 0) AS pure_secondary, CAST(sum(length(text) - length(replace(text, '—', ''))) AS BIGINT) AS em_dashes, CAST(sum(length(text) - length(replace(text, '–', ''))) AS BIGINT) AS en_dashes, CAST(sum(length(text) - length(replace(text, '-', ''))) AS BIGINT) AS hyphens FROM (SELECT text, {COUNT_SQL.format(PLAIN)} AS a, {COUNT_SQL.format(ACCENTED)} AS b FROM documents)")
def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.corpus_profile(read(spark, sf_dir, "documents"), "text", PLAIN, ACCENTED)
    return out.withColumn("mean_len", F.round("mean_len", 6))


@query("SELECT c AS symbol, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c NOT IN (SELECT unnest(string_split('abcdefghijklmnopqrstuvwxyz .,', ''))) AND c <> '' GROUP BY c")
def vocab_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.sql("SELECT explode(split('abcdefghijklmnopqrstuvwxyz .,', '')) AS symbol")
    return A.vocabulary_coverage(read(spark, sf_dir, "documents"), "text", known)


@query(f"SELECT coalesce(verdict, 'unknown') AS verdict, count(*) AS n FROM ({METADATA_SQL}) m LEFT JOIN ({VERDICTS_SQL}) v USING (wav) GROUP BY 1")
def verdict_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metadata(spark, sf_dir).select("wav").join(verdicts(spark, sf_dir), "wav", "left")
    return rows.groupBy(F.coalesce("verdict", F.lit("unknown")).alias("verdict")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n_rows, count(DISTINCT source) AS n_speakers, count(DISTINCT text) AS n_texts FROM documents")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").agg(F.count("*").alias("n_rows"), F.countDistinct("source").alias("n_speakers"), F.countDistinct("text").alias("n_texts"))


@query(f"""SELECT n_short, n_duplicate, n_dropped, CASE WHEN n_short + n_duplicate + n_dropped > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM (
SELECT count(*) FILTER (length(text) < 60) AS n_short, (SELECT count(*) - count(DISTINCT {COMPARE_SQL}) FROM documents WHERE {COMPARE_SQL} <> '') AS n_duplicate, (SELECT count(*) FROM ({CASCADE_SQL}) WHERE reason IS NOT NULL) AS n_dropped FROM documents)""")
def validation_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metadata(spark, sf_dir).select("text", F.nullif(T.normalize_compare("text"), F.lit("")).alias("norm"))
    counts = rows.agg(F.count_if(F.length("text") < 60).alias("n_short"), (F.count("norm") - F.countDistinct("norm")).alias("n_duplicate"))
    dropped = _cascaded(spark, sf_dir).agg(F.count("reason").alias("n_dropped"))
    both = counts.crossJoin(dropped)  # one row each
    names = ["n_short", "n_duplicate", "n_dropped"]
    return both.select(*names, overall_verdict({c: F.col(c) for c in names}).alias("verdict"))


PIECES_SQL = r"list_filter(string_split(regexp_replace(text, '([.!?…])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')"
PACK_SQL = rf"""WITH RECURSIVE s AS (SELECT doc_id, {PIECES_SQL} AS parts FROM documents),
f AS (SELECT doc_id, parts, 1 AS i, CAST([] AS VARCHAR[]) AS done FROM s
UNION ALL SELECT doc_id, parts, i + 1, CASE WHEN len(done) > 0 AND length(done[-1]) + 1 + length(parts[i]) <= 160 THEN list_append(done[:-2], done[-1] || ' ' || parts[i]) ELSE list_append(done, parts[i]) END FROM f WHERE i <= len(parts)),
g AS (SELECT doc_id, done FROM f WHERE i = len(parts) + 1),
h AS (SELECT doc_id, CASE WHEN len(done) >= 2 AND length(done[-1]) < 35 AND length(done[-2]) + 1 + length(done[-1]) <= 210 THEN list_append(done[:-3], done[-2] || ' ' || done[-1]) ELSE done END AS packed FROM g)
"""


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", all_long_parts(160)(T.sentences("text")).alias("parts"))
    return rows.select("doc_id", F.posexplode(greedy_pack(F.col("parts"))).alias("chunk", "text"))


#: SQL with a recursive fold, or none: on whole tables the recursion is too slow, so tests compare with a plain fold.
@query()
def greedy_pack_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


@query()
def chunk_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.chunk_quality(_packed(spark, sf_dir), "text")


@query("SELECT arg_max(name, o) AS name FROM (SELECT 'epoch=' || (o_orderkey % 1000) || '-step=' || o_orderkey || '.ckpt' AS name, (o_orderdate, o_orderkey) AS o FROM orders)")
def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders")
    name = F.concat(F.lit("epoch="), F.col("o_orderkey") % 1000, F.lit("-step="), "o_orderkey", F.lit(".ckpt"))
    return A.latest(rows.select(name.alias("name"), "o_orderdate", "o_orderkey"), "name", ["o_orderdate", "o_orderkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3")
def best_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three with the least loss, of which the price stands in; the limit is the feature."""
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(3)


@query("SELECT 'version_' || o_orderkey AS version FROM orders ORDER BY o_orderkey DESC LIMIT 1")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest numeric suffix, so that version_10 is after version_9."""
    rows = read(spark, sf_dir, "orders").select(F.concat(F.lit("version_"), "o_orderkey").alias("version"))
    return rows.agg(F.max_by("version", F.split_part("version", F.lit("_"), F.lit(2)).cast("bigint")).alias("version"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id")
def last_log_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))


@query("SELECT source AS shard, bool_or(length(text) < 10) AS failed FROM documents GROUP BY source")
def shard_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy(F.col("source").alias("shard")).agg(F.bool_or(F.length("text") < 10).alias("failed"))
