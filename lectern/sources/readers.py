"""Readers for the corpus files.

Pipe-delimited metadata has four dialects in use. The raw one splits at the
first bars and knows no quotes, so it stays a plain text scan. The quoted ones
need the standard CSV rules with record numbers, where a quoted field may span
lines: a file is one record set, so each file is parsed as a whole by one task.
Line numbers count within a file, from 1.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.functions import audio, text as T
from lectern.operators.joins import keep_last

CUTLIST = "src_audio string, start double, end double, text string, status string, sim double, text_orig string, review struct<verdict:string,note:string,original_text:string,replaced_audio:struct<orig_src_audio:string,orig_audio_path:string,new_audio_path:string,fix_dir:string,start:double,end:double,created_at:string,ffmpeg_cmd:array<string>>>"
MANIFEST = "audio_path string, text string, lang string, voice_id string, source string, sample_rate int, time_unix double, hash string, session string, meta string"
TO_ALIGN = "audio_path string, sentences array<string>, original_full_text string, manifest_meta map<string,string>"
VOICE_CONFIG = "audio struct<sample_rate:int,quality:string>, espeak struct<voice:string>, inference struct<noise_scale:double,length_scale:double,noise_w:double>, phoneme_type string, phoneme_id_map map<string,array<int>>, speaker_id_map map<string,int>, num_symbols int, num_speakers int, hop_length int"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, value) with line numbers, of files small enough for one row each."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    rows = files.select("path", F.posexplode(F.split("value", "\r?\n")).alias("line", "value"), F.size(F.split("value", "\r?\n")).alias("_n"))
    # A final line end starts no line.
    return rows.filter((F.col("line") + 1 < F.col("_n")) | (F.col("value") != "")).select("path", (F.col("line") + 1).alias("line"), "value")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Stripped lines without blank ones; splits large files."""
    return spark.read.text(path).select(T.strip("value").alias("text")).filter("text <> ''")


def raw_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The raw dialect: wav before the first bar, text after it, bars and quotes kept; blank lines skipped."""
    rows = lines(spark, path).filter("value <> ''")
    parts = F.split("value", "[|]", 2)
    return rows.select("path", F.col("line").alias("row_num"), F.get(parts, F.lit(0)).alias("wav"), F.get(parts, F.lit(1)).alias("text"), "value")


def metadata_map(spark: SparkSession, path: str) -> DataFrame:
    """wav to text, the last row of a wav counts; rows without a bar are left out."""
    rows = raw_metadata(spark, path).filter(F.col("text").isNotNull())
    return keep_last(rows, ["wav"], "row_num", ["text"])


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, value in zip(batch["path"], batch["value"]):
            rows = [(path, i, r) for i, r in enumerate(csv.reader(io.StringIO(value, newline=""), delimiter="|"), 1)]
            if rows:
                yield pd.DataFrame(rows, columns=["path", "row_num", "fields"])


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, row_num, fields) by the standard CSV rules with a bar as delimiter."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return files.mapInPandas(_records, "path string, row_num bigint, fields array<string>")


def quoted_metadata(spark: SparkSession, path: str) -> DataFrame:
    """All records, empty ones too; the text is the second field. ``issue``: empty_row, missing_text or null."""
    f = F.col("fields")
    issue = F.when(F.size(f) == 0, "empty_row").when(F.size(f) < 2, "missing_text")
    return quoted_records(spark, path).select("path", "row_num", F.coalesce(F.get(f, F.lit(0)), F.lit("")).alias("wav"), F.coalesce(F.get(f, F.lit(1)), F.lit("")).alias("text"), F.size(f).alias("n_fields"), issue.alias("issue"))


def normalised_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Records of two fields or more with stored-form texts; empty ones are left out."""
    rows = quoted_metadata(spark, path).filter("n_fields >= 2")
    return rows.select("path", "row_num", T.strip("wav").alias("wav"), T.normalize_store("text").alias("text")).filter("wav <> '' AND text <> ''")


def speaker_metadata(spark: SparkSession, path: str) -> DataFrame:
    """wav, speaker and the last field as text; fewer than three fields are an error."""
    f = F.col("fields")
    rows = quoted_records(spark, path).filter(F.size(f) > 0)
    checked = F.when(F.size(f) >= 3, F.element_at(f, -1)).otherwise(F.raise_error(F.concat(F.lit("fewer than 3 fields in record "), F.col("row_num"))))
    return rows.select("path", "row_num", F.get(f, F.lit(0)).alias("wav"), F.get(f, F.lit(1)).alias("speaker"), checked.alias("text"))


def parsed_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """``parsed`` and ``valid``: is the string a JSON object?"""
    whole = F.try_parse_json(F.col(column))
    return df.withColumn("valid", F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))).withColumn("parsed", F.from_json(column, schema))


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """(path, line, parsed, valid, raw); blank lines are skipped, a broken line is an error if ``strict``."""
    rows = parsed_json(lines(spark, path).filter(F.trim("value") != ""), "value", schema)
    if strict:
        bad = F.raise_error(F.concat(F.lit("broken JSON in line "), F.col("line")))
        rows = rows.withColumn("valid", F.when(F.col("valid"), True).otherwise(bad.cast("boolean")))
    return rows.withColumnRenamed("value", "raw")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Records with audio and text; broken lines are left out."""
    return jsonl(spark, path, MANIFEST).filter("valid AND parsed.audio_path IS NOT NULL AND parsed.text IS NOT NULL").select("path", "line", "parsed.*")


def cutlist(spark: SparkSession, path: str) -> DataFrame:
    """Typed cutlist rows with their line numbers."""
    return jsonl(spark, path, CUTLIST).filter("valid").select("path", "line", "parsed.*")


def to_align(spark: SparkSession, path: str) -> DataFrame:
    """audio_path and its sentences from a JSON array; blank sentences go, the last entry of an audio stays."""
    rows = spark.read.schema(TO_ALIGN).json(path, multiLine=True).withColumn("_o", F.monotonically_increasing_id())
    clean = F.filter("sentences", lambda s: F.trim(s) != "")
    return keep_last(rows.withColumn("sentences", clean), ["audio_path"], "_o", ["sentences", "original_full_text"])


def verdict_file(spark: SparkSession, path: str, required: tuple[str, ...] = ("wav", "verdict")) -> DataFrame:
    """The last verdict of each wav from a tab-separated file with a header."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="")
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    rows = rows.withColumn("_o", F.monotonically_increasing_id())
    return keep_last(rows, ["wav"], "_o", ["verdict"])


def issue_file(spark: SparkSession, path: str, old_root: str, new_root: str) -> DataFrame:
    """A low-similarity list with its paths moved to another root."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="")
    return rows.select(T.to_double("sim").alias("sim"), F.col("row").try_cast("bigint").alias("row"), "wav", "text", F.replace("wav_path", F.lit(old_root), F.lit(new_root)).alias("wav_path"))


def _base(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_listing(spark: SparkSession, path: str, glob: str = "*.[wW][aA][vV]", recursive: bool = False) -> DataFrame:
    """(path, wav) of files, without reading them."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", _base("path").alias("wav")).orderBy("path")


def wav_dirs(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Distinct ``wavs`` folders under several roots, with the rank of the root that shows them first."""
    found = [file_listing(spark, root, recursive=True).select(F.regexp_extract("path", r"^(.*/wavs)/[^/]+$", 1).alias("dir"), F.lit(i).alias("root")) for i, root in enumerate(roots)]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.filter("dir <> ''").groupBy("dir").agg(F.min("root").alias("root")).orderBy("root", "dir")


def name_list(spark: SparkSession, path: str) -> DataFrame:
    return text_lines(spark, path).filter(~F.col("text").startswith("#")).select(F.col("text").alias("path"))


def audio_info(spark: SparkSession, path: str) -> DataFrame:
    """wav and its header fields; broken files have an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[wW][aA][vV]").load(path)
    return files.select(_base("path").alias("wav"), audio.header("content").alias("h")).select("wav", "h.*")


def with_audio_info(rows: DataFrame, info: DataFrame) -> DataFrame:
    """Rows with header fields; ``missing_wav`` where there is no file."""
    out = rows.join(info.withColumn("_found", F.lit(True)), "wav", "left")
    return out.withColumn("error", F.when(F.col("_found").isNull(), "missing_wav").otherwise(F.col("error"))).drop("_found")


def voice_config(spark: SparkSession, path: str) -> DataFrame:
    """A voice's configuration with defaults for what is missing."""
    rows = spark.read.schema(VOICE_CONFIG).json(path, multiLine=True)
    default = lambda c, v: F.coalesce(F.col(c), F.lit(v))
    return rows.select(
        F.col("audio.sample_rate").alias("sample_rate"),
        F.col("espeak.voice").alias("espeak_voice"),
        default("inference.noise_scale", 0.667).alias("noise_scale"),
        default("inference.length_scale", 1.0).alias("length_scale"),
        default("inference.noise_w", 0.8).alias("noise_w"),
        default("phoneme_type", "espeak").alias("phoneme_type"),
        "phoneme_id_map",
        F.coalesce("speaker_id_map", F.create_map().cast("map<string,int>")).alias("speaker_id_map"),
        "num_symbols",
        "num_speakers",
        default("hop_length", 256).alias("hop_length"),
    )


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, id): non-blank lines numbered from 0."""
    from pyspark.sql import Window

    rows = lines(spark, path).filter(F.trim("value") != "")
    return rows.select(F.col("value").alias("symbol"), (F.row_number().over(Window.orderBy("path", "line")) - 1).alias("id"))


def dataset_config(spark: SparkSession, path: str) -> DataFrame:
    """sample_rate and voice of a dataset's configuration; nulls if the file is no JSON object."""
    rows = spark.read.text(path, wholetext=True)
    return parsed_json(rows, "value", "audio struct<sample_rate:int>, espeak struct<voice:string>").select(
        F.when(F.col("valid"), F.col("parsed.audio.sample_rate")).alias("sample_rate"), F.when(F.col("valid"), F.col("parsed.espeak.voice")).alias("voice")
    )


def dataset_state(spark: SparkSession, path: str) -> DataFrame:
    """One row: which of a dataset's parts are there."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_replace("path", "^.*?" + path.rstrip("/").replace(".", r"\.") + "/", "").alias("p"))
    return files.agg(
        F.coalesce(F.bool_or(F.col("p") == "config.json"), F.lit(False)).alias("config"),
        F.coalesce(F.bool_or(F.col("p") == "metadata_2col.csv"), F.lit(False)).alias("metadata"),
        F.coalesce(F.bool_or(F.col("p").startswith("wavs/")), F.lit(False)).alias("wavs"),
    )


def voice_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The sorted keys of a catalogue of voices."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return rows.select(F.explode(F.array_sort(F.map_keys("m"))).alias("voice"))


def model_catalogue(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Model files that have their configuration beside them; of equal names the first root's."""
    found = [spark.read.format("binaryFile").option("pathGlobFilter", "*.onnx*").load(r).select("path", F.lit(i).alias("root")) for i, r in enumerate(roots)]
    files = found[0]
    for more in found[1:]:
        files = files.union(more)
    configs = files.filter(F.col("path").endswith(".onnx.json")).select(F.regexp_replace("path", r"\.json$", "").alias("path"))
    models = files.filter(F.col("path").endswith(".onnx")).join(configs, "path", "left_semi")
    name = F.regexp_replace(_base("path"), r"\.onnx$", "")
    return models.withColumn("name", name).groupBy("name").agg(F.min_by("path", F.struct("root", "path")).alias("path"))


def private_ports(ports: Column | str, wanted: int = 22) -> Column:
    """The first entry of a list of port structs with the wanted private port."""
    c = F.col(ports) if isinstance(ports, str) else ports
    return F.get(F.filter(c, lambda p: p["privatePort"] == wanted), F.lit(0))
