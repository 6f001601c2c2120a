"""The corpus build: cutlist and sentence lists to a training-ready table, and its validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.functions import text as T
from lectern.operators import joins as J
from lectern.operators.rules import Rule, choose_text, multilabel, text_rules
from lectern.operators.sequence import after_first, numbered_names


def build_rows(cutlist: DataFrame, lists: DataFrame, policy: str = "auto", drop: tuple[str, ...] = ("drop", "bad", "skip", "missing")) -> DataFrame:
    """Cutlist rows with text, source, outcome and, for the kept ones, an output name.

    ``cutlist``: line, src_audio, start, end, text, review. ``lists``: audio_path, sentences.
    A dropped row still uses up its sentence. Replaced audio is taken whole.
    """
    rows = J.ordinal_join(cutlist, lists.select(F.col("audio_path").alias("src_audio"), "sentences"), "src_audio", "line", "sentences", "to_align_text")
    chosen = T.normalize_store(choose_text(policy, F.col("text"), F.col("to_align_text")))
    replaced = F.col("review.replaced_audio.new_audio_path")
    outcome = (
        F.when(F.lower(F.coalesce("review.verdict", F.lit(""))).isin(*drop), "skipped")
        .when(F.coalesce(chosen, F.lit("")) == "", "failed")
        .when(replaced.isNull() & (F.col("start").isNull() | F.col("end").isNull() | (F.col("end") <= F.col("start"))), "failed")
        .otherwise("kept")
    )
    made = rows.select(
        F.col("line").alias("cutlist_line"),
        F.coalesce(replaced, F.col("src_audio")).alias("src_audio"),
        F.when(replaced.isNull(), F.col("start")).alias("start"),
        F.when(replaced.isNull(), F.col("end")).alias("end"),
        replaced.alias("replaced_audio_path"),
        chosen.alias("text"),
        F.when((F.lit(policy) != "cutlist") & F.col("to_align_text").isNotNull(), "to_align").otherwise("cutlist").alias("text_source"),
        F.col("ordinal").alias("to_align_sentence_idx"),
        F.col("text").alias("cutlist_text"),
        "to_align_text",
        outcome.alias("outcome"),
    )
    named = numbered_names(made.filter("outcome = 'kept'"), "cutlist_line", "%08d.wav").withColumnRenamed("name", "out_wav")
    rest = made.filter("outcome <> 'kept'").withColumn("out_wav", F.lit(None).cast("string"))
    return named.unionByName(rest)


def sync_texts(cutlist: DataFrame, lists: DataFrame) -> DataFrame:
    """Cutlist rows with the sentence of their number as text; the first text that was replaced is kept as the original."""
    rows = J.ordinal_join(cutlist, lists.select(F.col("audio_path").alias("src_audio"), "sentences"), "src_audio", "line", "sentences", "_new")
    changed = F.col("_new").isNotNull() & (F.col("_new") != F.col("text"))
    original = F.when(changed & F.col("text_orig").isNull(), F.col("text")).otherwise(F.col("text_orig"))
    status = F.when(F.col("_new").isNull(), "missing").when(changed, "updated").otherwise("unchanged")
    rows = rows.withColumns({"text_orig": original, "sync": status})
    return rows.withColumn("text", F.coalesce("_new", "text")).drop("_new", "ordinal")


def validate(rows: DataFrame, info: DataFrame, expected_rate: int, min_len: int = 3, max_len: int = 400, min_share: float = 0.6, primary: str = T.CYRILLIC, secondary: str = T.LATIN, least_seconds: float = 0.2) -> DataFrame:
    """Issues (class, row, wav, text, issue) of metadata rows (row_num, wav, text, issue) against files (wav and header fields).

    Rows with a parse issue give that issue alone, and their files count as extra.
    A row whose file is missing is checked no further, nor is the format of a file that cannot be read.
    """
    parsed = rows.filter(F.col("issue").isNull())
    seen = after_first(parsed, "wav", "row_num").withColumnRenamed("duplicate", "_again")
    joined = seen.join(info.withColumn("_found", F.lit(True)), "wav", "left")
    missing = F.col("_found").isNull()
    rules = [Rule("missing_wav", missing), Rule("duplicate_wav", F.col("_again")), *[Rule(r.name, ~missing & r.fires, r.details) for r in text_rules("text", min_len, max_len, min_share, primary, secondary, strict=True)]]
    unread = F.col("error").isNotNull()
    rules.append(Rule("invalid_audio", ~missing & unread))
    for name, fires in (("not_mono", F.col("channels") != 1), ("not_pcm16", F.col("subtype") != "PCM_16"), ("sample_rate_mismatch", F.col("samplerate") != expected_rate), ("too_short", F.col("duration") <= least_seconds)):
        rules.append(Rule(name, ~missing & ~unread & fires))
    kinds = {"missing_wav": 0, "duplicate_wav": 1, "non_printable": 2, "too_short_text": 2, "too_long_text": 2, "low_script_share": 2}
    group = F.coalesce(*[F.when(F.col("issue") == k, F.lit(v)) for k, v in kinds.items()], F.lit(3))
    found = multilabel(joined.drop("issue"), rules, ["row_num", "wav", "text"]).select(group.alias("class"), F.col("row_num").cast("string").alias("row"), "wav", "text", "issue")
    broken = rows.filter(F.col("issue").isNotNull()).select(F.lit(2).alias("class"), F.col("row_num").cast("string").alias("row"), "wav", "text", "issue")
    extra = J.extra_files(info, parsed, "wav").select(F.lit(5).alias("class"), F.lit("-").alias("row"), "wav", F.lit("").alias("text"), F.lit("extra_wav").alias("issue"))
    return found.unionByName(broken).unionByName(extra)
