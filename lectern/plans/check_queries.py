"""Validation reports, catalogues, small array operators and alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import arrays as A, maps as M, phonemes, text as T, udfs
from lectern.operators.aggregates import issue_counts, retained
from lectern.operators.build import validate
from lectern.operators.rules import audio_rules, multilabel, whitelisted, with_status
from lectern.plans.array_queries import AUDIO_SQL, LETTERS, LETTERS_SQL
from lectern.plans.inputs import ACCENTED, METADATA_SQL, PLAIN, metadata, read
from lectern.plans.registry import query
from lectern.plans.text_queries import COUNT_SQL

#: Made-up headers of the files that ``labels`` names.
INFO_SQL = "SELECT 'd' || doc_id || '.wav' AS wav, CASE WHEN doc_id % 10 = 3 THEN 16000 ELSE 22050 END AS samplerate, CASE WHEN doc_id % 7 = 2 THEN 2 ELSE 1 END AS channels, CASE WHEN doc_id % 9 = 4 THEN 'FLOAT' ELSE 'PCM_16' END AS subtype, (doc_id % 50) / 10.0::DOUBLE AS duration, CASE WHEN doc_id % 13 = 5 THEN 'invalid_audio' END AS error FROM labels WHERE doc_id % 4 <> 1"
AUDIO_RULES_SQL = """SELECT wav, unnest(list_filter([CASE WHEN channels <> 1 THEN 'not_mono' END, CASE WHEN subtype <> 'PCM_16' THEN 'not_pcm16' END, CASE WHEN samplerate <> 22050 THEN 'sample_rate_mismatch' END, CASE WHEN duration <= CAST(0.2 AS DOUBLE) THEN 'too_short' END], lambda x: x IS NOT NULL)) AS issue"""


def _info(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return read(spark, sf_dir, "labels").filter(i % 4 != 1).select(
        F.concat(F.lit("d"), i, F.lit(".wav")).alias("wav"),
        F.when(i % 10 == 3, 16000).otherwise(22050).alias("samplerate"),
        F.when(i % 7 == 2, 2).otherwise(1).alias("channels"),
        F.when(i % 9 == 4, "FLOAT").otherwise("PCM_16").alias("subtype"),
        ((i % 50) / 10).alias("duration"),
        F.when(i % 13 == 5, "invalid_audio").alias("error"),
    )


@query(f"{AUDIO_RULES_SQL} FROM ({INFO_SQL})")
def audio_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multilabel(_info(spark, sf_dir), audio_rules("channels", "subtype", "samplerate", "duration", 22050), ["wav"]).select("wav", "issue")


VALIDATE_SQL = rf"""WITH m AS (SELECT row, wav, text, {COUNT_SQL.format(ACCENTED)} AS a, {COUNT_SQL.format(PLAIN)} AS b FROM ({METADATA_SQL})), i AS ({INFO_SQL}),
f AS (SELECT * FROM m JOIN i USING (wav)),
v AS (SELECT CAST(row AS VARCHAR) AS row, wav, 'missing_wav' AS issue FROM m WHERE wav NOT IN (SELECT wav FROM i)
UNION ALL SELECT CAST(row AS VARCHAR), wav, unnest(list_filter([CASE WHEN regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]') THEN 'non_printable' END, CASE WHEN length(text) < 60 THEN 'too_short_text' END, CASE WHEN length(text) > 3000 THEN 'too_long_text' END, CASE WHEN a < CAST(0.05 AS DOUBLE) * (a + b) OR a + b = 0 THEN 'low_script_share' END, error], lambda x: x IS NOT NULL)) FROM f
UNION ALL SELECT CAST(row AS VARCHAR), wav, issue FROM f JOIN ({AUDIO_RULES_SQL} FROM i WHERE error IS NULL) USING (wav)
UNION ALL SELECT '-', wav, 'extra_wav' FROM i WHERE wav NOT IN (SELECT wav FROM m))
"""


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metadata(spark, sf_dir).withColumnRenamed("row", "row_num").withColumn("issue", F.lit(None).cast("string"))
    return validate(rows, _info(spark, sf_dir), 22050, 60, 3000, 0.05, ACCENTED, PLAIN)


@query(VALIDATE_SQL + "SELECT row, wav, issue FROM v")
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select("row", "wav", "issue")


@query(VALIDATE_SQL + "SELECT issue, count(*) AS n FROM v GROUP BY issue")
def validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issue_counts(_validated(spark, sf_dir), "issue")


@query("""SELECT o_orderkey, list_sort(list(why)) AS why FROM (SELECT o_orderkey, 'best' AS why FROM (SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3)
UNION ALL SELECT o_orderkey, 'last' FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5) UNION ALL SELECT o_orderkey, 'every' FROM orders WHERE o_orderkey % 5000 = 0) GROUP BY o_orderkey""")
def retained_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of the least loss, the last five and every 5000th step; the numbers are the feature."""
    return retained(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", 3, 5, 5000)


def _similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "benchmark")
    heard = rows.select("item_id", T.normalize_compare(F.regexp_replace("text", "[aeo]", "")).alias("hyp"))
    return rows.select("item_id", T.normalize_compare("text").alias("ref")).join(heard, "item_id").select("item_id", udfs.similarity("ref", "hyp").alias("sim"))


@query()
def low_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose recognised text is too far from the given one."""
    return _similar(spark, sf_dir).filter("sim < 0.9").select("item_id", F.concat(F.lit("low_similarity:"), F.format_number("sim", 3)).alias("issue"))


@query()
def similarity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir).agg(F.min("sim").alias("min_sim"), F.avg("sim").alias("avg_sim"))


@query(f"SELECT item_id, list_filter(s, lambda c: list_contains({LETTERS_SQL}, c)) AS valid, len(list_filter(s, lambda c: NOT list_contains({LETTERS_SQL}, c))) = 0 AS clean FROM (SELECT item_id, string_split(lower(text), '') AS s FROM benchmark)")
def valid_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.array(*[F.lit(c) for c in LETTERS])
    rows = read(spark, sf_dir, "benchmark").select("item_id", F.split(F.lower("text"), "").alias("s"))
    rows = rows.select("item_id", "s", phonemes.valid_symbols("s", known).alias("valid"))
    return rows.select("item_id", "valid", (F.size("s") == F.size("valid")).alias("clean"))


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'bad' ELSE 'ok' END AS verdict, quality AS note, 16000 AS rate FROM labels")
def nested_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict put beside a note that stays, and a rate two levels down."""
    rows = read(spark, sf_dir, "labels").select("doc_id", "toxic", F.struct(F.col("quality").alias("note"), F.lit("").alias("verdict"), F.struct(F.lit(22050).alias("rate")).alias("audio")).alias("review"))
    rows = rows.withColumn("review", M.upsert("review", "verdict", F.when(F.col("toxic") == 1, "bad").otherwise("ok")))
    rows = rows.withColumn("review", M.upsert("review", "audio.rate", F.lit(16000)))
    return rows.select("doc_id", "review.verdict", "review.note", "review.audio.rate")


@query("SELECT event_id FROM events WHERE event_type = 'error'")
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_status(read(spark, sf_dir, "events"), "event_type", "error").select("event_id")


@query("SELECT doc_id, lang, source FROM documents")
def metadata_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known names of the wanted ones, in a struct; unknown ones are passed over."""
    return whitelisted(read(spark, sf_dir, "documents"), ["lang", "source", "speaker"], ["doc_id"]).select("doc_id", "meta.*")


@query(f"SELECT vec_id, list_transform(range(32), lambda i: round((a[i + 1] + a[i + 33]) / 2, 6)) AS mono FROM ({AUDIO_SQL})")
def mono_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves of a vector as two channels."""
    half = lambda s: F.transform(F.slice("embedding", s, 32), lambda x: x.cast("double"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", A.mono(F.array(half(1), half(33))).alias("m"))
    return rows.select("vec_id", F.transform("m", lambda x: A.rounded(x, 6)).alias("mono"))


@query(f"SELECT vec_id, round(list_sum(a[1 : 1 + vec_id % 64]) / (1 + vec_id % 64), 6) AS mean FROM ({AUDIO_SQL})".replace("a[1 : 1 + vec_id % 64]", "a[1 : CAST(1 + vec_id % 64 AS BIGINT)]"))
def masked_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    mask = F.transform("x", lambda _, i: F.when(i <= F.col("vec_id") % 64, 1.0).otherwise(0.0))
    return rows.select("vec_id", F.round(A.masked_mean(F.col("x"), mask), 6).alias("mean"))


@query("SELECT item_id, CAST(i AS INTEGER) AS place, CASE WHEN i > 0 THEN 8820 ELSE 0 END AS pause FROM (SELECT item_id, unnest(range(len(string_split(text, ' ')))) AS i FROM benchmark)")
def pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of silence before each part but the first."""
    rows = read(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split("text", " ")).alias("place", "part"))
    return rows.select("item_id", "place", F.when(F.col("place") > 0, F.size(A.silence(22050, 0.2))).otherwise(0).alias("pause"))


@query()
def monotonic_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as sixteen frames of four symbols: the symbol of each frame on the best path."""
    scores = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice("embedding", i * 4 + 1, F.lit(4)))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", scores.cast("array<array<double>>").alias("s"))
    return rows.select("vec_id", udfs.best_monotonic("s").alias("path"))
