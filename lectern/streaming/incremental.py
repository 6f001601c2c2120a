"""Streaming variants of the incremental operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lectern.functions import text as T
from lectern.operators.rules import Rule, cascade


def line_source(spark: SparkSession, path: str) -> DataFrame:
    """Stripped non-blank lines of files as they arrive."""
    return spark.readStream.text(path).select(T.strip("value").alias("text")).filter("text <> ''")


def sentence_stream(lines: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence, so a consumer can start before a text is done."""
    return lines.select(*[c for c in lines.columns if c != text], F.posexplode(T.sentences(text)).alias("sentence", text))


def cascade_stream(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows with the name of the first rule that fires; stateless, so append mode holds."""
    return rows.withColumn("reason", cascade(rules))


def first_seen(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Rows whose key was not seen within the watermark; state older than ``delay`` is dropped."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def ordinals(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Running numbers from 0 per key over all batches: the cursor of an ordinal join.

    Rows of a key must arrive in order; a late row takes the next number.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", ordinal bigint"

    def number(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        parts = list(batches)
        if parts:
            own = pd.concat(parts).sort_values(order, kind="stable")
            own["ordinal"] = range(n, n + len(own))
            state.update((n + len(own),))
            yield own

    return rows.groupBy(key).applyInPandasWithState(number, schema, "n bigint", "append", GroupStateTimeout.NoTimeout)


def run_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, write Parquet, and stop; a restart goes on from the checkpoint."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()
