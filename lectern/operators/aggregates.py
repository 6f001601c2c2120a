"""Aggregates of corpus reports: profiles, percentiles, histograms, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions import text as T


def describe(value: str, percents: tuple[int, ...] = (50, 95)) -> list[Column]:
    """Count, extremes, mean and exact percentiles with linear interpolation; null on no rows."""
    c = F.col(value)
    return [F.count(c).alias("count"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), *[F.percentile(c, p / 100).alias(f"p{p}") for p in percents]]


def histogram(df: DataFrame, value: str, edges: list[float], width: int = 40) -> DataFrame:
    """Rows of (bin, low, high, count, bar) for half-open bins, the last one closed; values outside are dropped.

    All bins appear, also empty ones; bars scale with the largest count.
    """
    v, last = F.col(value), len(edges) - 2
    inside = [F.when((v >= edges[i]) & ((v < edges[i + 1]) if i < last else (v <= edges[i + 1])), F.lit(i)) for i in range(last + 1)]
    counts = df.agg(*[F.count_if(x.isNotNull()).alias(f"c{i}") for i, x in enumerate(inside)])
    bins = F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(float(edges[i])).alias("low"), F.lit(float(edges[i + 1])).alias("high"), F.col(f"c{i}").alias("count")) for i in range(last + 1)])
    top = F.greatest(*[F.col(f"c{i}") for i in range(last + 1)]) if last else F.col("c0")
    rows = counts.select(F.explode(bins).alias("b"), top.alias("top")).select("b.*", "top")
    bar = F.repeat(F.lit("#"), F.when(F.col("top") > 0, F.floor(F.col("count") / F.col("top") * width)).otherwise(0).cast("int"))
    return rows.withColumn("bar", bar).drop("top")


def reason_counts(df: DataFrame, reason: str) -> DataFrame:
    return df.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n")).orderBy(reason)


def corpus_profile(df: DataFrame, text: str, primary: str = T.CYRILLIC, secondary: str = T.LATIN) -> DataFrame:
    """One row: size, length statistics, script mix and dash code points."""
    rows = df.select(F.col(text).alias("_t"), F.length(text).alias("_n"), T.letter_count(text, primary).alias("_a"), T.letter_count(text, secondary).alias("_b"))
    a, b = F.col("_a") > 0, F.col("_b") > 0
    dash = lambda c: F.sum(F.regexp_count("_t", F.lit(c))).cast("long")
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.sum("_n").cast("long").alias("chars"),
        F.min("_n").alias("min_len"),
        F.avg("_n").alias("mean_len"),
        F.max("_n").alias("max_len"),
        F.count_if(a & ~b).alias("pure_primary"),
        F.count_if(a & b).alias("mixed"),
        F.count_if(~a & b).alias("pure_secondary"),
        dash("—").alias("em_dashes"),
        dash("–").alias("en_dashes"),
        dash("-").alias("hyphens"),
    )


def vocabulary_coverage(df: DataFrame, text: str, known: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Characters of the texts that ``known`` does not hold, with how often they occur."""
    chars = df.select(F.explode(F.filter(F.split(text, ""), lambda c: c != "")).alias(symbol)).groupBy(symbol).agg(F.count("*").alias("n"))
    return chars.join(known.select(symbol), symbol, "left_anti")


def chunk_quality(df: DataFrame, text: str, short: int = 35, long: int = 230) -> DataFrame:
    n = F.length(text)
    return df.agg(
        F.count("*").alias("n"), F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.avg(n).alias("mean_len"), F.percentile(n, 0.5).alias("median_len"), F.count_if(n < short).alias("n_short"), F.count_if(n > long).alias("n_long")
    )


def latest(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """The name of the greatest row."""
    return df.agg(F.max_by(name, F.struct(*order, name)).alias(name))


def issue_counts(df: DataFrame, issue: str) -> DataFrame:
    return df.groupBy(issue).agg(F.count("*").alias("n"))


def retained(df: DataFrame, step: str, loss: str, best: int = 3, last: int = 5, every: int = 5000) -> DataFrame:
    """Steps to keep and why: the ``best`` of least loss, the ``last`` ones, and each multiple of ``every``."""
    why = lambda rows, name: rows.select(step, F.lit(name).alias("why"))
    kept = why(df.orderBy(loss, step).limit(best), "best").unionByName(why(df.orderBy(F.col(step).desc()).limit(last), "last"))
    return kept.unionByName(why(df.filter(F.col(step) % every == 0), "every")).groupBy(step).agg(F.array_sort(F.collect_set("why")).alias("why"))
