"""The driver tables in the shapes of the corpus: metadata, verdicts, segments, timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: The driver's texts hold no Cyrillic, so plain and accented Latin letters stand for two scripts.
PLAIN, ACCENTED = "[A-Za-z]", "[À-ÿ]"
#: Characters read per second, which gives a segment its length.
CHARS_PER_SECOND = 15.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row, wav, text) from ``documents``."""
    return read(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("row"), F.concat(F.lit("d"), F.col("doc_id"), F.lit(".wav")).alias("wav"), "text")


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(wav, verdict) from ``labels``."""
    verdict = F.when(F.col("toxic") == 1, "bad").when(F.col("quality") == 1, "ok").otherwise("skip")
    return read(spark, sf_dir, "labels").select(F.concat(F.lit("d"), F.col("doc_id"), F.lit(".wav")).alias("wav"), verdict.alias("verdict"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prefix, seg, duration, text) from ``conversations``."""
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("prefix"), F.col("turn").cast("int").alias("seg"), (F.length("text") / CHARS_PER_SECOND).alias("duration"), "text")


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, line, start, end) from ``events``; intervals of errors are holes."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    hole = F.col("event_type") == "error"
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("src"),
        F.struct("ts", "event_id").alias("line"),
        "event_id",
        F.when(~hole, at).alias("start"),
        F.when(~hole, at + F.col("value")).alias("end"),
    )


METADATA_SQL = "SELECT doc_id + 1 AS row, 'd' || doc_id || '.wav' AS wav, text FROM documents"
VERDICTS_SQL = "SELECT 'd' || doc_id || '.wav' AS wav, CASE WHEN toxic = 1 THEN 'bad' WHEN quality = 1 THEN 'ok' ELSE 'skip' END AS verdict FROM labels"
SEGMENTS_SQL = "SELECT conv_id AS prefix, CAST(turn AS INTEGER) AS seg, length(text) / 15.0 AS duration, text FROM conversations"
