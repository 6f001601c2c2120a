"""Text functions, rules and cascades over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import text as T
from lectern.operators.aggregates import reason_counts
from lectern.operators.rules import Rule, cascade, filter_rules, multilabel, text_rules
from lectern.operators.sequence import after_first
from lectern.plans.inputs import ACCENTED, METADATA_SQL, PLAIN, metadata, read
from lectern.plans.registry import query

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
SQUEEZE = r"regexp_replace({0}, '\s+', ' ', 'g')"
COMPARE_SQL = STRIP.format(SQUEEZE.format(r"regexp_replace(lower(text), '[^a-zа-яё0-9\s]', ' ', 'g')"))
STORE_SQL = STRIP.format(SQUEEZE.format(r"regexp_replace(text, '[\r\n|]', ' ', 'g')"))
COUNT_SQL = "len(regexp_extract_all(text, '{0}'))"
TOKENS_SQL = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda t: t <> '')"


@query(f"SELECT doc_id, {COMPARE_SQL} AS norm FROM documents")
def normalize_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.normalize_compare("text").alias("norm"))


@query(f"SELECT doc_id, {STORE_SQL} AS stored FROM documents")
def normalize_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.normalize_store("text").alias("stored"))


CLEAN_SQL = STRIP.format("replace(replace(regexp_replace(" + SQUEEZE.format("text") + r", ' ([.,!?;:])', '\1', 'g'), ' - ', ' — '), '|', ' ')")


@query(f"SELECT doc_id, {CLEAN_SQL} AS cleaned FROM documents")
def clean_manifest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.clean_text("text").alias("cleaned"))


NAME_SQL = "regexp_replace(regexp_replace(regexp_replace(replace(" + STRIP.format("url") + r", ' ', '_'), '[^0-9A-Za-z._-]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(f"SELECT page_id, CASE WHEN lower(n) LIKE '%.wav' THEN n ELSE n || '.wav' END AS name FROM (SELECT page_id, coalesce(nullif({NAME_SQL}, ''), 'utt') AS n FROM pages)")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", T.safe_out_name("url").alias("name"))


@query(r"""SELECT conv_id, turn, regexp_matches(""" + STRIP.format("text") + r""", '[.!?…]+["'')\]]*$') AS ends FROM conversations""")
def boundary_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", T.is_boundary("text").alias("ends"))


@query(r"""SELECT conv_id, turn, nullif(regexp_extract(w, '(?i)^(.+?)_(\d+)\.wav$', 1), '') AS prefix, CAST(nullif(regexp_extract(w, '(?i)^(.+?)_(\d+)\.wav$', 2), '') AS INTEGER) AS seg
FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'c_' || conv_id || '_' || turn || '.WAV' ELSE 'c' || conv_id || '.wav' END AS w FROM conversations)""")
def name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    wav = F.when(F.col("role") == "user", F.concat_ws("_", F.lit("c"), "conv_id", F.concat("turn", F.lit(".WAV")))).otherwise(F.concat(F.lit("c"), "conv_id", F.lit(".wav")))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", T.name_prefix(wav).alias("prefix"), T.name_segment(wav).alias("seg"))


@query(f"SELECT doc_id, {COUNT_SQL.format(PLAIN)} AS n_plain, {COUNT_SQL.format(ACCENTED)} AS n_accented, CASE WHEN {COUNT_SQL.format('[A-Za-zÀ-ÿ]')} > 0 THEN round({COUNT_SQL.format(PLAIN)} / {COUNT_SQL.format('[A-Za-zÀ-ÿ]')}, 6) END AS share FROM documents")
def script_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda c: T.letter_count("text", c).cast("long")
    return read(spark, sf_dir, "documents").select("doc_id", count(PLAIN).alias("n_plain"), count(ACCENTED).alias("n_accented"), F.round(T.script_share("text", PLAIN, ACCENTED), 6).alias("share"))


@query(f"SELECT doc_id FROM (SELECT doc_id, {COUNT_SQL.format(PLAIN)} AS a, {COUNT_SQL.format(ACCENTED)} AS b FROM documents) WHERE a > 0 AND b > 0 AND b / (a + b) >= 0.1")
def code_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").filter(T.code_switch("text", PLAIN, ACCENTED)).select("doc_id")


@query(r"SELECT doc_id, regexp_matches(t, '[\x00-\x08\x0B\x0C\x0E-\x1F]') AS flagged FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || chr(7) ELSE text END AS t FROM documents)")
def nonprintable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh text gets a control character, as the driver's texts have none."""
    text = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.char(F.lit(7)))).otherwise(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", text.rlike(T.NON_PRINTABLE).alias("flagged"))


@query(r"SELECT doc_id, t AS piece FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?…])\s+', '\1' || chr(1), 'g'), chr(1))) AS t FROM documents) WHERE trim(t) <> ''")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.explode(T.sentences("text")).alias("piece"))


MODE_SQL = "coalesce(list_max(map_values(list_aggregate({0}, 'histogram'))), 0)"


@query(f"SELECT doc_id, len(w) AS n, CASE WHEN len(w) < 6 THEN 0.0 ELSE round({MODE_SQL.format('w')} / len(w), 6) END AS share FROM (SELECT doc_id, {TOKENS_SQL.format(COMPARE_SQL)} AS w FROM documents)")
def token_mode_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = read(spark, sf_dir, "documents").select("doc_id", T.tokens(T.normalize_compare("text")).alias("w"))
    return words.select("doc_id", F.size("w").cast("long").alias("n"), F.round(T.mode_share("w"), 6).alias("share"))


@query(r"SELECT doc_id, regexp_matches(t, '^[^\p{L}\p{N}]+$') AS punctuation FROM (SELECT doc_id, regexp_replace(text, '[a-z]', '', 'g') AS t FROM documents)")
def punctuation_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without their lower-case letters, of which some hold no letter or digit at all."""
    return read(spark, sf_dir, "documents").select("doc_id", T.punctuation_only(F.regexp_replace("text", "[a-z]", "")).alias("punctuation"))


@query(r"SELECT page_id, regexp_replace(html, '\([^)]+\)', '', 'g') AS flagless, left(page_id || '_' || regexp_replace(url, '[^0-9A-Za-z._ -]+', '', 'g'), 50) AS cache_id, translate(html, '—–', '--') AS dashes FROM pages")
def page_text_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", T.strip_flags("html").alias("flagless"), T.cache_id("page_id", "url").alias("cache_id"), T.plain_dashes("html").alias("dashes"))


@query(r"""SELECT conv_id, turn, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped, TRY_CAST(CASE WHEN turn % 2 = 0 THEN CAST(turn AS VARCHAR) ELSE left(text, 3) END AS DOUBLE) AS number, left(text, 1) AS first_char FROM conversations""")
def word_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    loose = F.when(F.col("turn") % 2 == 0, F.col("turn").cast("string")).otherwise(F.left("text", F.lit(3)))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", T.html_escape("text").alias("escaped"), T.to_double(loose).alias("number"), T.first_code_point("text").alias("first_char"))


@query(r"""SELECT v, nullif(regexp_extract(v, p, 1), '') AS lang_family, nullif(regexp_extract(v, p, 2), '') AS lang_region, nullif(regexp_extract(v, p, 3), '') AS voice_name, nullif(regexp_extract(v, p, 4), '') AS voice_quality
FROM (SELECT lang || '_' || upper(lang) || CASE WHEN doc_id % 5 = 0 THEN '/' ELSE '-' END || source || '-medium' AS v, '^([^-_]+)_([^-_]+)-([^-]+)-([^-]+)$' AS p FROM documents)""")
def voice_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("doc_id") % 5 == 0, "/").otherwise("-")
    v = read(spark, sf_dir, "documents").select(F.concat("lang", F.lit("_"), F.upper("lang"), mark, "source", F.lit("-medium")).alias("v"))
    return v.select("v", T.voice_name("v").alias("s")).select("v", "s.*")


@query("SELECT event_id, list_sort(list_distinct(list_filter(list_transform(string_split(o, ','), lambda x: lower(trim(x))), lambda x: x <> ''))) AS options FROM (SELECT event_id, event_type || ', ' || upper(event_type) || ',,k' || (user_id % 3) AS o FROM events)")
def option_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.concat("event_type", F.lit(", "), F.upper("event_type"), F.lit(",,k"), F.col("user_id") % 3)
    return read(spark, sf_dir, "events").select("event_id", T.option_set(o).alias("options"))


def _suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of all rows; an empty file name or text is its row's only issue."""
    empty = (F.coalesce("wav", F.lit("")) == "") | (F.coalesce("text", F.lit("")) == "")
    rows = metadata(spark, sf_dir).withColumn("norm", F.when(~empty, T.normalize_compare("text")))
    rows = after_first(rows, "norm", "row").withColumns({"words": T.tokens("norm"), "a": T.letter_count("text", PLAIN), "b": T.letter_count("text", ACCENTED), "size": F.length("text")})
    # Counted once here, as the rules and their details below use them several times.
    rows = rows.withColumns({"top": T.mode_count("words"), "n": F.size("words")})
    a, b, n, size, top = (F.col(c) for c in ("a", "b", "n", "size", "top"))
    ratio = lambda name, part, whole: F.concat(F.lit(name + "="), F.format_number(part / whole, 3))
    checks = [
        Rule("non_printable", F.col("text").rlike(T.NON_PRINTABLE)),
        Rule("too_short_text", size < 200, size.cast("string")),
        Rule("too_long_text", size > 4000, size.cast("string")),
        Rule("low_script_share", a < 0.9 * (a + b), ratio("cyr_ratio", a, a + b)),
        Rule("code_switch", (a > 0) & (b > 0) & (b / (a + b) >= 0.15), ratio("lat_ratio", b, a + b)),
        Rule("high_token_repetition", (n >= 6) & (10 * top >= n), ratio("score", top, n)),
        Rule("duplicate_text", F.col("duplicate")),
    ]
    rules = [Rule("empty_wav_or_text", empty), *[Rule(r.name, ~empty & r.fires, r.details) for r in checks]]
    found = multilabel(rows, rules, ["row", "wav", "text"])
    return found.select("row", "wav", "issue", "details", "position", F.left(F.translate("text", "\t", " "), F.lit(80)).alias("text"))


SUSPECTS_SQL = rf"""WITH m AS (SELECT row, wav, text, {COUNT_SQL.format(PLAIN)} AS a, {COUNT_SQL.format(ACCENTED)} AS b, {COMPARE_SQL} AS norm FROM ({METADATA_SQL})),
w AS (SELECT *, {TOKENS_SQL.format('norm')} AS words, row_number() OVER (PARTITION BY norm ORDER BY row) AS seen FROM m WHERE wav <> '' AND text <> ''),
r AS (SELECT *, {MODE_SQL.format('words')} AS top, len(words) AS n FROM w),
s AS (
SELECT row, wav, text, 'empty_wav_or_text' AS issue, '' AS details, 0 AS position FROM m WHERE coalesce(wav, '') = '' OR coalesce(text, '') = ''
UNION ALL SELECT row, wav, text, 'non_printable', '', 1 FROM r WHERE regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]')
UNION ALL SELECT row, wav, text, 'too_short_text', CAST(length(text) AS VARCHAR), 2 FROM r WHERE length(text) < 200
UNION ALL SELECT row, wav, text, 'too_long_text', CAST(length(text) AS VARCHAR), 3 FROM r WHERE length(text) > 4000
UNION ALL SELECT row, wav, text, 'low_script_share', printf('cyr_ratio=%.3f', a / (a + b)), 4 FROM r WHERE a < CAST(0.9 AS DOUBLE) * (a + b)
UNION ALL SELECT row, wav, text, 'code_switch', printf('lat_ratio=%.3f', b / (a + b)), 5 FROM r WHERE a > 0 AND b > 0 AND b / (a + b) >= CAST(0.15 AS DOUBLE)
UNION ALL SELECT row, wav, text, 'high_token_repetition', printf('score=%.3f', top / n), 6 FROM r WHERE n >= 6 AND 10 * top >= n
UNION ALL SELECT row, wav, text, 'duplicate_text', '', 7 FROM r WHERE seen > 1 AND norm <> ''),
o AS (SELECT row, wav, issue, details, position, left(replace(text, chr(9), ' '), 80) AS text FROM s)
"""


@query(SUSPECTS_SQL + "SELECT * FROM o ORDER BY issue, row, position LIMIT 200")
def suspects_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 issues; the limit is the report's."""
    return _suspects(spark, sf_dir).orderBy("issue", "row", "position").limit(200)


@query(SUSPECTS_SQL + "SELECT * FROM o")
def suspects_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suspects(spark, sf_dir)


VALIDATOR_SQL = rf"""SELECT row, 'non_printable' AS issue FROM ({METADATA_SQL}) WHERE regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]')
UNION ALL SELECT row, 'too_short_text' FROM ({METADATA_SQL}) WHERE length(text) < 60
UNION ALL SELECT row, 'too_long_text' FROM ({METADATA_SQL}) WHERE length(text) > 3000
UNION ALL SELECT row, 'low_script_share' FROM (SELECT row, {COUNT_SQL.format(ACCENTED)} AS a, {COUNT_SQL.format(PLAIN)} AS b FROM ({METADATA_SQL})) WHERE a < CAST(0.05 AS DOUBLE) * (a + b) OR a + b = 0"""


@query(VALIDATOR_SQL)
def validator_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = text_rules("text", 60, 3000, 0.05, ACCENTED, PLAIN, strict=True)
    return multilabel(metadata(spark, sf_dir), rules, ["row"]).select("row", "issue")


def _cascaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metadata(spark, sf_dir).select("row", F.when(F.col("row") % 97 == 0, "").otherwise(F.col("wav")).alias("wav"), T.normalize_store("text").alias("text"), (F.length("text") / 150.0).alias("duration"))
    rules = filter_rules("wav", "text", "duration", 2.0, 30.0, 350, 4000, r"(?U)^[^\W_]+ .*")
    return rows.withColumn("reason", cascade(rules))


CASCADE_SQL = rf"""SELECT row, wav, CASE WHEN wav = '' THEN 'empty_wav' WHEN duration < 2 THEN 'too_short' WHEN duration > 30 THEN 'too_long' WHEN length(text) < 350 THEN 'text_too_short'
WHEN length(text) > 4000 THEN 'text_too_long' WHEN regexp_matches(text, '^[\p{{L}}\p{{N}}]+ ') THEN 'text_regex' END AS reason
FROM (SELECT doc_id + 1 AS row, CASE WHEN (doc_id + 1) % 97 = 0 THEN '' ELSE 'd' || doc_id || '.wav' END AS wav, {STORE_SQL} AS text, length(text) / 150.0 AS duration FROM documents)"""


@query(CASCADE_SQL)
def rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascaded(spark, sf_dir).select("row", "wav", "reason")


@query(f"SELECT reason, count(*) AS n FROM ({CASCADE_SQL}) WHERE reason IS NOT NULL GROUP BY reason ORDER BY reason")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_counts(_cascaded(spark, sf_dir), "reason")


@query(f"SELECT lpad(CAST(row_number() OVER (ORDER BY row) - 1 AS VARCHAR), 8, '0') || '.wav' AS name, row FROM ({CASCADE_SQL}) WHERE reason IS NULL")
def kept_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.operators.sequence import numbered_names

    return numbered_names(_cascaded(spark, sf_dir).filter("reason IS NULL").select("row"), "row", "%08d.wav").select("name", "row")


@query(f"SELECT row FROM (SELECT row, norm, row_number() OVER (PARTITION BY norm ORDER BY row) AS seen FROM (SELECT row, {COMPARE_SQL} AS norm FROM ({METADATA_SQL}))) WHERE seen > 1 AND norm <> ''")
def dup_text_after_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metadata(spark, sf_dir).select("row", T.normalize_compare("text").alias("norm"))
    return after_first(rows, "norm", "row").filter("duplicate").select("row")
