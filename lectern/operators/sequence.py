"""Order-dependent operators: gap filling, greedy folds, numbering, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from lectern.functions import text as T


def contiguous_runs(df: DataFrame, source: str, order: str, within: list[str] | None = None) -> DataFrame:
    """``run``: number of the contiguous run of equal ``source`` in ``order``.

    With ``within`` the rows are numbered inside these keys, which also deals the
    sort to many tasks; without it the order is global, as in one file.
    """
    w = Window.partitionBy(*(within or [])).orderBy(order)
    changed = F.coalesce((F.lag(source).over(w) != F.col(source)).cast("int"), F.lit(0))
    return df.withColumn("_c", changed).withColumn("run", F.sum("_c").over(w)).drop("_c")


def gap_fill(df: DataFrame, keys: list[str], order: str, start: str = "start", end: str = "end", reach: float = 10.0) -> DataFrame:
    """``filled_start`` and ``filled_end`` of intervals with holes.

    A missing start is the nearest earlier end in the run, a missing end the
    nearest later start. What is still missing lies ``reach`` from the other
    side, not before 0; if both sides are missing both stay null.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.last(end, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(start, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    near = df.withColumn("_s", F.coalesce(F.col(start), before)).withColumn("_e", F.coalesce(F.col(end), after))
    low = F.when(F.col("_s").isNull() & F.col("_e").isNotNull(), F.greatest(F.lit(0.0), F.col("_e") - reach)).otherwise(F.col("_s"))
    high = F.when(F.col("_e").isNull() & F.col("_s").isNotNull(), F.col("_s") + reach).otherwise(F.col("_e"))
    return near.withColumn("filled_start", low).withColumn("filled_end", high).drop("_s", "_e")


def padded_view(start: Column, end: Column, pad: float) -> tuple[Column, Column]:
    """The interval with context; null sides stay null."""
    return F.when(start.isNotNull(), F.greatest(F.lit(0.0), start - pad)), end + pad


def greedy_pack(parts: Column, target: int = 160, orphan: int = 35, slack: int = 50) -> Column:
    """Sentences packed in order into texts of up to ``target`` characters, joined by a space.

    A last text shorter than ``orphan`` joins the one before if that stays within ``target + slack``.
    """
    empty = F.array().cast("array<string>")

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        fits = last.isNotNull() & (F.length(last) + 1 + F.length(s) <= target)
        return F.when(fits, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat_ws(" ", last, s)))).otherwise(F.concat(acc, F.array(s)))

    def tail(acc: Column) -> Column:
        last, prior = F.try_element_at(acc, F.lit(-1)), F.try_element_at(acc, F.lit(-2))
        joins = (F.size(acc) >= 2) & (F.length(last) < orphan) & (F.length(prior) + 1 + F.length(last) <= target + slack)
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 2), F.array(F.concat_ws(" ", prior, last)))).otherwise(acc)

    return F.aggregate(parts, empty, step, tail)


CHUNK = "struct<first int, last int, n int, duration double, text string>"


def greedy_merge(df: DataFrame, key: str, segment: str, duration: str, text: str, boundary: str, hard_max: float = 15.0, tiny: float = 1.6, tiny_chars: int = 10, target_min: float = 2.5) -> DataFrame:
    """Neighbouring segments of a key merged into chunks.

    A chunk closes before it would exceed ``hard_max``. While it is tiny it goes
    on; from ``target_min`` on it closes where a segment ends a sentence. A tiny
    last chunk joins the one before, also beyond ``hard_max``. Texts of chunks
    are stored in normal form, and chunks without text go before that. ``boundary``
    is a boolean column: does the segment's text end a sentence?
    """
    rows = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(segment).cast("int").alias("s"), F.col(duration).alias("d"), F.col(text).alias("t"), F.col(boundary).alias("b")))).alias("_rows"))
    start = F.struct(F.array().cast(f"array<{CHUNK}>").alias("chunks"), F.lit(True).alias("closed"))

    def chunk(first: Column, last: Column, n: Column, d: Column, t: Column) -> Column:
        return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"), n.cast("int").alias("n"), d.alias("duration"), t.alias("text"))

    def is_tiny(c: Column) -> Column:
        return (c["duration"] < tiny) | (F.length(T.strip(c["text"])) < tiny_chars)

    def step(acc: Column, r: Column) -> Column:
        open_ = F.try_element_at(acc.chunks, F.lit(-1))
        joins = ~acc.closed & (open_["duration"] + r.d <= hard_max)
        grown = chunk(open_["first"], r.s, open_["n"] + 1, open_["duration"] + r.d, F.concat_ws(" ", open_["text"], r.t))
        fresh = chunk(r.s, r.s, F.lit(1), r.d, r.t)
        now = F.when(joins, grown).otherwise(fresh)
        kept = F.when(joins, F.slice(acc.chunks, 1, F.size(acc.chunks) - 1)).otherwise(acc.chunks)
        return F.struct(F.concat(kept, F.array(now)).alias("chunks"), (~is_tiny(now) & (now["duration"] >= target_min) & r.b).alias("closed"))

    def tail(acc: Column) -> Column:
        stored = F.transform(acc.chunks, lambda x: chunk(x["first"], x["last"], x["n"], x["duration"], T.normalize_store(x["text"])))
        c = F.filter(stored, lambda x: x["text"] != "")
        last, prior = F.try_element_at(c, F.lit(-1)), F.try_element_at(c, F.lit(-2))
        both = chunk(prior["first"], last["last"], prior["n"] + last["n"], prior["duration"] + last["duration"], F.concat_ws(" ", prior["text"], last["text"]))
        return F.when((F.size(c) >= 2) & is_tiny(last), F.concat(F.slice(c, 1, F.size(c) - 2), F.array(both))).otherwise(c)

    return rows.select(key, F.posexplode(F.aggregate("_rows", start, step, tail)).alias("chunk", "_c")).select(key, "chunk", "_c.*")


def after_first(df: DataFrame, value: str, order: str) -> DataFrame:
    """``duplicate``: true for rows whose non-empty value was seen before.

    The first rows are found by a partial aggregate and joined back, so a value
    that many rows share is never sorted in one task.
    """
    first = df.filter(F.col(value) != "").groupBy(value).agg(F.min(order).alias("_first"))
    return df.join(first, value, "left").withColumn("duplicate", F.coalesce(F.col("_first") < F.col(order), F.lit(False))).drop("_first")


#: Values of an integer order that are numbered together.
STRETCH = 1 << 16


def global_rank(df: DataFrame, block: Column, order: list[Column], name: str) -> DataFrame:
    """``name``: the rank (from 1) of each row by ``order``; ``block`` must not fall along that order.

    Ranks inside a block come from a window over its rows, and what precedes a block
    from the counts of all blocks, of which there are far fewer than rows. Null
    blocks come first, as nulls do in the order.
    """
    inside = df.withColumn("_block", block).withColumn("_inside", F.row_number().over(Window.partitionBy("_block").orderBy(*order)))
    # Counted by the window's own exchange, which is reused where ``df`` holds little besides its order.
    counts = inside.groupBy("_block").agg(F.max("_inside").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("_block").alias("_start_of"), F.coalesce(before, F.lit(0)).alias("_start"))
    placed = inside.join(starts, F.col("_block").eqNullSafe(F.col("_start_of")))
    return placed.withColumn(name, F.col("_start") + F.col("_inside")).drop("_block", "_start_of", "_start", "_inside")


def numbered_names(df: DataFrame, order: str, pattern: str, keys: list[str] | None = None) -> DataFrame:
    """``name`` from the running number (from 0) of the kept rows, per key or overall.

    Overall numbers of integer ``order`` are counted by stretches of it, so that no task sorts all rows.
    """
    if not keys and isinstance(df.schema[order].dataType, IntegralType):
        numbered = global_rank(df, F.floor(F.col(order) / STRETCH), [F.col(order)], "_n")
        return numbered.withColumn("name", F.format_string(pattern, F.col("_n") - 1)).drop("_n")
    n = F.row_number().over(Window.partitionBy(*(keys or [])).orderBy(order)) - 1
    return df.withColumn("name", F.format_string(pattern, *[F.col(k) for k in keys or []], n))


def round_robin(row: Column, shards: int) -> Column:
    """Shard of a row number from 1."""
    return (row - 1) % shards


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows that the seed determines; for a report, so the limit is the feature."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def split_sizes(df: DataFrame, key: str, val_share: float = 0.1, n_test: int = 5, seed: int = 42) -> DataFrame:
    """``part`` of exact sizes: floor(n * val_share) val, ``n_test`` test, the rest train."""
    total = df.agg(F.count("*").alias("_n"))
    hashed = F.xxhash64(F.col(key), F.lit(seed))
    ranked = global_rank(df, F.shiftright(hashed, 48), [hashed, F.col(key)], "_r")
    n_val = F.floor(F.col("_n") * val_share)
    part = F.when(F.col("_r") <= n_val, "val").when(F.col("_r") <= n_val + n_test, "test").otherwise("train")
    return ranked.join(F.broadcast(total)).withColumn("part", part).drop("_r", "_n")  # one row
