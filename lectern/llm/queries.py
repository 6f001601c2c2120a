"""The registered queries of this package, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.common import held_out, table


def word_vocabulary() -> str:
    """The tokenizer file of the packing query; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm import language_id

    documents = table(spark, sf_dir, "documents")
    model = language_id.train(documents, "text", "lang", ~held_out("doc_id", 3, 1))
    found = language_id.identify(documents, model)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "languages", "proportions")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm import secret_scan

    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm import pairwise_quality

    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 4, 2))
    model = pairwise_quality.train(documents, labels, "doc_id", "text", "quality")
    found = pairwise_quality.rank(documents, model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


#: Categories in chain order, as conditions over ``labels``: toxic junk, toxic prose, and from both what is toxic at all.
TOXICITY = {"toxic_junk": "toxic = 1 AND quality = 0", "toxic_prose": "toxic = 1 AND quality = 1", "toxic": "toxic = 1"}


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the last model of the chain finds toxic, with the probabilities of all categories."""
    from lectern.llm import toxicity

    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), TOXICITY)
    return toxicity.judge(documents, model).filter("is_toxic")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm import suffix_dedup

    return suffix_dedup.digest(suffix_dedup.dedup(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), word_vocabulary())


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written as files in the shared folder and read back; a gap or an open revisit fails the query."""
    from lectern.llm import warc
    from lectern.llm.common import checkpoint, shared_folder

    folder = shared_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    # Payloads stay out of what is joined.
    records = warc.resolve(checkpoint(warc.read_archives(warc.archive_files(spark, folder)).drop("payload")))
    sound = F.col("resolved") & (F.col("record_type") != "quarantined")
    kind = F.when(sound, F.col("record_type")).otherwise(F.raise_error(F.concat(F.lit("damaged archive: "), F.col("archive_id"), F.lit(" at "), F.col("offset"))))
    return records.select(warc.page_key("record_id").alias("page_id"), "payload_bytes", "payload_digest", kind.alias("record_type"), warc.page_key("refers_to").alias("refers_to"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontaminate": op4_decontaminate,
    "op5_pairwise_quality": op5_pairwise_quality,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
}

#: SQL for whole queries. The others need an estimate, a model, a tokenizer, an alignment or a decoder, and are tested
#: against brute force or held-out labels.
ORACLES: dict[str, str] = {
    "op2_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END) AS s FROM words
), sizes AS (
  SELECT doc_id, len(s) AS n, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS class_id FROM sets
), grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a)
SELECT sizes.doc_id, sizes.n AS n_shingles, sizes.class_id, min(reach.other) AS component_id
FROM sizes JOIN reach ON reach.doc_id = sizes.doc_id GROUP BY ALL""",
    "op7_suffix_dedup": """
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM w JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)
), marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM r
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run
), total AS (
  SELECT d.doc_id, d.n, d.h, coalesce(sum(b - a), 0)::BIGINT AS gone, count(a) AS spans, coalesce(max(b), 0) AS rest FROM d LEFT JOIN spans ON spans.doc_id = d.doc_id GROUP BY ALL
), pieces AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS s, a AS e FROM spans
  UNION ALL SELECT doc_id, rest, n FROM total
), kept AS (
  SELECT p.doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS k FROM pieces p JOIN total t ON t.doc_id = p.doc_id GROUP BY p.doc_id
)
SELECT t.doc_id, t.n AS n_bytes, t.gone AS n_removed, t.spans AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM total t JOIN kept ON kept.doc_id = t.doc_id""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p""",
}
