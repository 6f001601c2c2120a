"""Operators that run Python on Arrow batches; without SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import arrays, audio, text as T, udfs
from lectern.plans.inputs import read
from lectern.plans.registry import query


@query()
def similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark text against a damaged copy."""
    rows = read(spark, sf_dir, "benchmark").select("item_id", T.normalize_compare("text").alias("ref"), T.normalize_compare(F.regexp_replace("text", "e", "")).alias("hyp"))
    return rows.select("item_id", F.round(udfs.similarity("ref", "hyp"), 6).alias("sim"))


@query()
def nfd_phonemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select("item_id", udfs.nfd_symbols("text").alias("symbols"))


@query()
def phonemize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with given phonemes after 60 characters."""
    marked = F.concat(F.left("text", F.lit(60)), F.lit(" [[ tˈɛst ]] "), F.expr("substring(text, 61)"))
    return read(spark, sf_dir, "benchmark").select("item_id", udfs.phonemizer()(marked).alias("sentences"))


@query()
def long_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", F.explode(T.sentences("text")).alias("s"))
    return rows.select("doc_id", F.explode(udfs.long_parts()("s")).alias("part"))


@query()
def stft_mag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(audio.stft(32, 8)("embedding")).alias("frame", "m"))
    return rows.select("vec_id", "frame", F.transform("m", lambda x: F.round(x, 6)).alias("magnitude"))


@query()
def mel_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(audio.mel(16000, 32, 8, 8)("embedding")).alias("frame", "m"))
    return rows.select("vec_id", "frame", F.transform("m", lambda x: F.round(x, 5)).alias("mel"))


@query()
def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.transform(audio.resampled(16000, 22050)("embedding"), lambda x: F.round(x, 6)).alias("audio"))


@query()
def wav_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips as WAV bytes, and what their headers say."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", audio.as_wav(16000)(arrays.to_int16("embedding")).alias("content"))
    return rows.select("vec_id", audio.header("content").alias("h")).select("vec_id", "h.*")


@query()
def synthesize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to ids to audio with the silent stand-in model."""
    from lectern.plans.array_queries import letter_map

    rows = read(spark, sf_dir, "benchmark").select("item_id", F.posexplode(T.sentences("text")).alias("sentence", "s"))
    ids = rows.select("item_id", "sentence", arrays.symbol_ids(F.split(F.lower("s"), ""), letter_map()).alias("ids"))
    made = ids.select("item_id", "sentence", F.size("ids").alias("n_ids"), udfs.synthesizer()("ids").alias("audio"))
    return made.select("item_id", "sentence", "n_ids", F.size("audio").alias("n_samples"))
