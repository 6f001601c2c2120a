"""Joins, set operations and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators import joins as J
from lectern.operators.sequence import numbered_names, round_robin
from lectern.plans.inputs import METADATA_SQL, SEGMENTS_SQL, VERDICTS_SQL, metadata, read, segments, verdicts
from lectern.plans.registry import query


@query(f"SELECT row, wav, verdict FROM ({METADATA_SQL}) m LEFT JOIN ({VERDICTS_SQL}) v USING (wav) WHERE verdict IS NULL OR lower(verdict) NOT IN ('bad', 'missing')")
def verdict_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = J.with_verdicts(metadata(spark, sf_dir).select("row", "wav"), verdicts(spark, sf_dir), "wav")
    return rows.filter("NOT dropped").select("row", "wav", "verdict")


#: A verdict list with repeated keys: each label, then a second opinion on every third one.
DOUBLED_SQL = "SELECT doc_id, 2 * doc_id AS line, CASE WHEN toxic = 1 THEN 'bad' ELSE 'ok' END AS verdict FROM labels UNION ALL SELECT doc_id, 2 * doc_id + 1, 'skip' FROM labels WHERE doc_id % 3 = 0"


@query(f"SELECT doc_id, arg_max(verdict, line) AS verdict FROM ({DOUBLED_SQL}) GROUP BY doc_id")
def keep_last_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    first = labels.select("doc_id", (F.col("doc_id") * 2).alias("line"), F.when(F.col("toxic") == 1, "bad").otherwise("ok").alias("verdict"))
    again = labels.filter("doc_id % 3 = 0").select("doc_id", (F.col("doc_id") * 2 + 1).alias("line"), F.lit("skip").alias("verdict"))
    return J.keep_last(first.unionByName(again), ["doc_id"], "line", ["verdict"])


@query("SELECT text, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def keep_first_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.keep_first(read(spark, sf_dir, "documents").withColumn("_o", F.col("doc_id")), ["text"], "_o", ["doc_id", "source"])


#: Files on disk: those of labelled documents, and some that no row names.
FILES_SQL = f"SELECT wav FROM ({VERDICTS_SQL}) UNION ALL SELECT 'x' || doc_id || '.wav' FROM labels WHERE doc_id % 4 = 0"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    return verdicts(spark, sf_dir).select("wav").union(labels.filter("doc_id % 4 = 0").select(F.concat(F.lit("x"), "doc_id", F.lit(".wav"))))


@query(f"SELECT row, wav, text FROM ({METADATA_SQL}) WHERE wav NOT IN ({FILES_SQL})")
def missing_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.missing_refs(metadata(spark, sf_dir), _files(spark, sf_dir), "wav").select("row", "wav", "text")


@query(f"SELECT wav FROM ({FILES_SQL}) WHERE wav NOT IN (SELECT wav FROM ({METADATA_SQL}))")
def extra_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.extra_files(_files(spark, sf_dir), metadata(spark, sf_dir), "wav")


@query(f"SELECT row, wav FROM ({METADATA_SQL}) WHERE wav IN ({FILES_SQL})")
def existing_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata(spark, sf_dir).select("row", "wav").join(_files(spark, sf_dir), "wav", "left_semi").select("row", "wav")


@query("""SELECT key, coalesce(a, 0) AS cutlist_rows, coalesce(b, 0) AS sentences, greatest(coalesce(a, 0) - coalesce(b, 0), 0) AS missing, greatest(coalesce(b, 0) - coalesce(a, 0), 0) AS extra
FROM (SELECT user_id % 200 AS key, count(*) AS a FROM events GROUP BY 1) FULL JOIN (SELECT conv_id AS key, count(*) AS b FROM conversations GROUP BY 1) USING (key)""")
def key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = read(spark, sf_dir, "events").select((F.col("user_id") % 200).alias("key"))
    right = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("key"))
    return J.key_report(left, right, "key", "cutlist_rows", "sentences")


@query("SELECT key FROM (SELECT user_id % 200 AS key FROM events UNION SELECT conv_id FROM conversations) ORDER BY key")
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = read(spark, sf_dir, "events").select((F.col("user_id") % 200).alias("key"))
    return left.union(read(spark, sf_dir, "conversations").select("conv_id")).distinct().orderBy("key")


ORDINAL_SQL = r"""WITH r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ordinal, text FROM conversations),
l AS (SELECT doc_id AS conv_id, list_filter(string_split(text, chr(10)), lambda s: trim(s) <> '') AS lines FROM documents),
s AS (SELECT r.conv_id, turn, CAST(ordinal AS INTEGER) AS ordinal, r.text, lines[ordinal + 1] AS sentence FROM r LEFT JOIN l USING (conv_id))
"""


def _synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    lines = F.filter(F.split("text", "\n"), lambda s: F.trim(s) != "")
    lists = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), lines.alias("lines"))
    return J.ordinal_join(rows, lists, "conv_id", "turn", "lines", "sentence").select("conv_id", "turn", "ordinal", "text", "sentence")


@query(ORDINAL_SQL + "SELECT conv_id, turn, ordinal, sentence FROM s")
def ordinal_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synced(spark, sf_dir).select("conv_id", "turn", "ordinal", "sentence")


@query(ORDINAL_SQL + "SELECT conv_id, count(*) AS total, count(*) FILTER (sentence IS NULL) AS missing, count(*) FILTER (sentence <> text) AS updated, count(*) FILTER (sentence = text) AS unchanged FROM s GROUP BY conv_id")
def sync_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _synced(spark, sf_dir)
    return rows.groupBy("conv_id").agg(
        F.count("*").alias("total"), F.count_if(F.col("sentence").isNull()).alias("missing"), F.count_if(F.col("sentence") != F.col("text")).alias("updated"), F.count_if(F.col("sentence") == F.col("text")).alias("unchanged")
    )


@query(ORDINAL_SQL + "SELECT conv_id, turn, left(text, 160) AS old, left(sentence, 160) AS new FROM s WHERE sentence <> text ORDER BY conv_id, turn LIMIT 50")
def sync_mismatch_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 differences; the limit is the report's."""
    rows = _synced(spark, sf_dir).filter("sentence <> text").orderBy("conv_id", "turn").limit(50)
    return rows.select("conv_id", "turn", F.left("text", F.lit(160)).alias("old"), F.left("sentence", F.lit(160)).alias("new"))


@query(ORDINAL_SQL + "SELECT conv_id, turn, coalesce(sentence, text) AS auto, sentence AS to_align, CASE WHEN sentence IS NULL THEN 'failed' WHEN turn % 4 = 3 THEN 'skipped' ELSE 'kept' END AS outcome FROM s")
def text_source_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.operators.rules import choose_text

    outcome = F.when(F.col("sentence").isNull(), "failed").when(F.col("turn") % 4 == 3, "skipped").otherwise("kept")
    pick = lambda p: choose_text(p, F.col("text"), F.col("sentence")).alias(p)
    return _synced(spark, sf_dir).select("conv_id", "turn", pick("auto"), pick("to_align"), outcome.alias("outcome"))


@query("""SELECT row, wav, arg_min(path, (priority, path)) AS resolved FROM (SELECT doc_id + 1 AS row, 'd' || doc_id || '.wav' AS wav FROM documents) LEFT JOIN
(SELECT 'd' || doc_id || '.wav' AS wav, 'root' || p || '/d' || doc_id || '.wav' AS path, p AS priority FROM labels, (SELECT unnest([1, 2, 3]) AS p) WHERE (doc_id + p) % 3 <> 0) USING (wav) GROUP BY row, wav""")
def resolve_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    wav = F.concat(F.lit("d"), F.col("doc_id"), F.lit(".wav"))
    index = read(spark, sf_dir, "labels").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("priority")).filter("(doc_id + priority) % 3 <> 0")
    index = index.select(wav.alias("wav"), F.concat(F.lit("root"), F.col("priority"), F.lit("/"), wav).alias("path"), "priority")
    return J.resolve_first(metadata(spark, sf_dir).select("row", "wav"), index, "wav").select("row", "wav", "resolved")


ENCODE_SQL = "SELECT source, min(doc_id) AS first_row, CAST(row_number() OVER (ORDER BY min(doc_id)) - 1 AS INTEGER) AS code FROM documents GROUP BY source"


@query(ENCODE_SQL)
def speaker_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.encode_first_seen(read(spark, sf_dir, "documents"), "source", "doc_id")


@query(f"SELECT doc_id, code FROM documents JOIN ({ENCODE_SQL}) USING (source)")
def speaker_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents")
    return rows.select("doc_id", "source").join(J.encode_first_seen(rows, "source", "doc_id"), "source").select("doc_id", "code")


@query(f"""SELECT issue, row, wav FROM (SELECT 0 AS c, 'missing_wav' AS issue, CAST(row AS VARCHAR) AS row, wav FROM ({METADATA_SQL}) WHERE wav NOT IN ({FILES_SQL})
UNION ALL SELECT 1, 'too_long_text', CAST(row AS VARCHAR), wav FROM ({METADATA_SQL}) WHERE length(text) > 4000
UNION ALL SELECT 2, 'extra_wav', '-', wav FROM ({FILES_SQL}) WHERE wav NOT IN (SELECT wav FROM ({METADATA_SQL}))) ORDER BY c, row, wav""")
def issue_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, files = metadata(spark, sf_dir), _files(spark, sf_dir)
    part = lambda df, c, issue, row: df.select(F.lit(c).alias("c"), F.lit(issue).alias("issue"), row.alias("row"), "wav")
    row = F.col("row").cast("string")
    out = part(J.missing_refs(rows, files, "wav"), 0, "missing_wav", row).unionByName(part(rows.filter(F.length("text") > 4000), 1, "too_long_text", row))
    return out.unionByName(part(J.extra_files(files, rows, "wav"), 2, "extra_wav", F.lit("-"))).orderBy("c", "row", "wav").select("issue", "row", "wav")


@query("SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INTEGER) AS shard FROM documents")
def round_robin_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers of documents are their dense ids plus one, so no sort is needed to know them."""
    rows = read(spark, sf_dir, "documents")
    return rows.select("doc_id", round_robin(F.col("doc_id") + 1, 4).cast("int").alias("shard"))


@query("SELECT name, count(*) AS times FROM (SELECT sha256(text) AS name FROM documents) GROUP BY name HAVING count(*) > 1")
def shard_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that the content gives, so equal texts collide; of fixed size, so no text is shuffled."""
    return J.assert_unique(read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("name")), "name")


@query(f"SELECT prefix, seg, printf('%d_%04d.wav', prefix, row_number() OVER (PARTITION BY prefix ORDER BY seg) - 1) AS name FROM ({SEGMENTS_SQL}) WHERE duration BETWEEN 2 AND 15 AND length(text) BETWEEN 6 AND 300")
def segment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segments(spark, sf_dir).filter("duration BETWEEN 2 AND 15 AND length(text) BETWEEN 6 AND 300").select("prefix", "seg", F.col("prefix").cast("string").alias("p"))
    return numbered_names(rows, "seg", "%s_%04d.wav", ["p"]).select("prefix", "seg", "name")


@query(f"SELECT prefix, seg FROM ({SEGMENTS_SQL}) WHERE duration BETWEEN 2 AND 15 AND length(text) BETWEEN 6 AND 300")
def segment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).filter("duration BETWEEN 2 AND 15 AND length(text) BETWEEN 6 AND 300").select("prefix", "seg")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.remaining(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, coalesce(CAST(quality AS BIGINT), length(text)) AS result FROM documents LEFT JOIN labels USING (doc_id)")
def resume_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("result"))
    rows = read(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("_n"))
    return J.resumed(rows, before, "doc_id", "result", F.col("_n")).select("doc_id", "result")


@query("SELECT name, noise, length, doc_id FROM (SELECT unnest(['calm', 'lively', 'slow']) AS name, unnest([0.333::DOUBLE, 0.8, 0.5]) AS noise, unnest([1.0::DOUBLE, 0.9, 1.25]) AS length), (SELECT doc_id FROM documents)")
def presets_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parameter sweep: each text with three presets, which is a constant factor."""
    presets = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("noise"), F.lit(b).alias("length")) for n, a, b in (("calm", 0.333, 1.0), ("lively", 0.8, 0.9), ("slow", 0.5, 1.25))])
    rows = read(spark, sf_dir, "documents")
    return rows.select("doc_id", F.explode(presets).alias("p")).select("p.*", "doc_id")


@query(f"SELECT prefix, seg FROM (SELECT prefix, seg, dense_rank() OVER (ORDER BY prefix) AS r FROM ({SEGMENTS_SQL})) WHERE r <= 10")
def first_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All segments of the first ten prefixes; the limit is the feature. Ranks distinct prefixes alone."""
    rows = segments(spark, sf_dir).select("prefix", "seg")
    return rows.join(rows.select("prefix").distinct().orderBy("prefix").limit(10), "prefix", "left_semi")
