"""A corpus pipeline of five stages over ``documents``.

Quality rules drop documents, the n-gram Jaccard join keeps the least id of each
group of near duplicates, decontamination drops documents that hold a benchmark
item, the secret scan cuts secrets out of the texts, and best-fit packing deals
what is left into sequences. Each stage is written as Parquet in the shared
folder and read again as the next one's input.

No stage has an equivalent in SQL as a whole (robust covariance steps, alignment,
tokenisation), so ``ORACLE_SQL`` is None and tests compare with plain Python.

Defined results, at every stage: a null text counts as empty; a null language or
source is a group of its own; rows without a doc_id are judged one by one by
their own texts; an empty table stays empty; further columns go along, whatever
their names. Each stage says what it does with rows that repeat an id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.common import checkpoint, shared_folder
from lectern.llm.decontaminate import find_leaks
from lectern.llm.jaccard_join import jaccard_components
from lectern.llm.packing import pack
from lectern.llm.quality_rules import quality_rules
from lectern.llm.queries import word_vocabulary
from lectern.llm.secret_scan import redact

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
KEY = "_pipeline_row"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``KEY``: the doc_id, or for each row without one a number above all of them, written so that it stays."""
    most = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0]
    unnamed = docs.filter("doc_id is null").withColumn(KEY, F.monotonically_increasing_id() + (max(most or 0, 0) + 1))
    return docs.filter("doc_id is not null").withColumn(KEY, F.col("doc_id").cast("long")).unionByName(checkpoint(unnamed))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the outlier test keep; each row is judged by its own text, also where ids repeat.

    An empty or null text goes, as it has under 20 words.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = quality_rules(docs.withColumn(KEY, whole), carry=(KEY,))
    return judged.filter("kept").select(f"{KEY}.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each component of documents with a similarity of 0.8 on five-word shingles; no id comes last.

    Rows that repeat an id are one document, of which one row stays; texts without a word have no duplicates.
    """
    rows = _keyed(docs)
    groups = jaccard_components(rows, KEY, k=5, percent=80)
    return rows.join(groups.filter(f"{KEY} = component_id").select(KEY), KEY, "left_semi").dropDuplicates([KEY]).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; where one of the rows that repeat an id holds one, all of them go."""
    rows = _keyed(docs)
    leaks = find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), KEY)
    return rows.join(leaks.select(KEY).distinct(), KEY, "left_anti").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with a mark in place of each secret; a null text stays null, and n_chars is counted again."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of at most 2048 tokens; rows that repeat an id are packed apart."""
    return pack(docs, word_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what lies between them goes to a folder of its own under the shared one, and is removed once it is used."""
    folder = shared_folder(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        before = path
    return docs
