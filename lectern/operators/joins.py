"""Joins of corpora with verdicts, sentence lists and file listings.

No side is broadcast by hand: sizes are left to the planner, which broadcasts a
side that its statistics show to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.operators.rules import dropped_by_verdict


def keep_last(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """One row per key with the values of its last row; a partial aggregate, not a sort."""
    last = F.max_by(F.struct(*values), F.col(order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def keep_first(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    first = F.min_by(F.struct(*values), F.col(order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")


def with_verdicts(rows: DataFrame, verdicts: DataFrame, on: str, drop: tuple[str, ...] = ("bad", "missing")) -> DataFrame:
    """Rows with ``verdict`` (null: unknown) and ``dropped``; ``verdicts`` has one row per key."""
    return rows.join(verdicts.select(on, "verdict"), on, "left").withColumn("dropped", dropped_by_verdict(F.col("verdict"), drop))


def ordinal_join(rows: DataFrame, lists: DataFrame, key: str, order: str, items: str, item: str = "item") -> DataFrame:
    """The n-th row of a key beside the n-th element of the key's list.

    Every row takes a number, also one that is dropped later, and also where the
    list is too short or missing; ``item`` is null there.
    """
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)
    elements = lists.select(key, F.posexplode(items).alias("_n", item))
    return numbered.join(elements, [key, "_n"], "left").withColumnRenamed("_n", "ordinal")


def missing_refs(rows: DataFrame, files: DataFrame, on: str) -> DataFrame:
    return rows.join(files.select(on), on, "left_anti")


def extra_files(files: DataFrame, rows: DataFrame, on: str) -> DataFrame:
    """Files that no row refers to."""
    return files.select(on).join(rows.select(on), on, "left_anti")


def key_report(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """Counts of both sides per key, with what is missing on the right and what is extra there."""
    a = left.groupBy(key).agg(F.count("*").alias(left_name))
    b = right.groupBy(key).agg(F.count("*").alias(right_name))
    n = {c: F.coalesce(c, F.lit(0)).cast("long") for c in (left_name, right_name)}
    return a.join(b, key, "full_outer").select(
        key,
        *[v.alias(c) for c, v in n.items()],
        F.greatest(n[left_name] - n[right_name], F.lit(0)).alias("missing"),
        F.greatest(n[right_name] - n[left_name], F.lit(0)).alias("extra"),
    )


def resolve_first(rows: DataFrame, index: DataFrame, on: str, candidate: str = "path", priority: str = "priority") -> DataFrame:
    """Each row with the candidate of least priority; the index is reduced before the join."""
    best = index.groupBy(on).agg(F.min_by(candidate, F.struct(priority, candidate)).alias("resolved"))
    return rows.join(best, on, "left")


def encode_first_seen(rows: DataFrame, value: str, order: str) -> DataFrame:
    """Dense numbers from 0 for the distinct values, in the order in which they are first seen."""
    first = rows.groupBy(value).agg(F.min(order).alias("first_row"))
    # One row per distinct value is ranked, not one per input row.
    return first.withColumn("code", F.row_number().over(Window.orderBy("first_row")) - 1)


def remaining(todo: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """What is left to do after a restart."""
    return todo.join(done.select(on), on, "left_anti")


def resumed(rows: DataFrame, before: DataFrame, on: str, value: str, fresh: Column) -> DataFrame:
    """Earlier results where there are any, else ``fresh``."""
    old = before.select(on, F.col(value).alias("_old"))
    return rows.join(old, on, "left").withColumn(value, F.coalesce(F.col("_old"), fresh)).drop("_old")


def assert_unique(df: DataFrame, name: str) -> DataFrame:
    """The names that occur more than once, with how often."""
    return df.groupBy(name).agg(F.count("*").alias("times")).filter("times > 1")
