"""Clauses, symbol groups and diacritics as higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Clause marks that end a sentence, and those that go on after a space (fixed values).
FINAL, INNER = (".", "?", "!"), (",", ":", ";")
#: Arabic vowel signs, the superscript alef among them (fixed values).
DIACRITICS = "[ً-ْٰ]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clause_sentences(clauses: Column | str) -> Column:
    """Sentences of clauses (struct of text and mark): marks are added, inner ones with a space, final ones end a sentence."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, c: Column) -> Column:
        mark = F.coalesce(c["mark"], F.lit(""))
        now = F.concat(acc["open"], c["text"], mark, F.when(mark.isin(*INNER), F.lit(" ")).otherwise(F.lit("")))
        final = mark.isin(*FINAL)
        return F.struct(F.when(final, F.concat(acc["done"], F.array(now))).otherwise(acc["done"]).alias("done"), F.when(final, F.lit("")).otherwise(now).alias("open"))

    return F.aggregate(_col(clauses), start, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def symbol_groups(code_points: Column | str) -> Column:
    """Lengths of the groups that zeros separate in a flat list of code points."""
    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("n"))

    def step(acc: Column, c: Column) -> Column:
        return F.struct(F.when(c == 0, F.concat(acc["done"], F.array(acc["n"]))).otherwise(acc["done"]).alias("done"), F.when(c == 0, F.lit(0)).otherwise(acc["n"] + 1).alias("n"))

    return F.aggregate(_col(code_points), start, step, lambda acc: F.when(acc["n"] > 0, F.concat(acc["done"], F.array(acc["n"]))).otherwise(acc["done"]))


def split_diacritics(text: Column | str) -> Column:
    """Letters (struct of char and marks) with the vowel signs that follow each; digits become ``#``."""
    points = F.filter(F.split(F.regexp_replace(_col(text), r"(?U)\d", "#"), ""), lambda c: c != "")
    start = F.array().cast("array<struct<char: string, marks: string>>")

    def step(acc: Column, c: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["char"].alias("char"), F.concat(last["marks"], c).alias("marks"))
        return F.when(c.rlike(DIACRITICS) & (F.size(acc) > 0), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(F.struct(c.alias("char"), F.lit("").alias("marks")))))

    return F.aggregate(points, start, step)


def annotate(letters: Column, marks: Column) -> Column:
    """Text of letters with a list of marks put after them, in order; missing marks are empty."""
    return F.array_join(F.zip_with(letters, marks, lambda c, m: F.concat(c, F.coalesce(m, F.lit("")))), "")


def valid_symbols(symbols: Column | str, known: Column) -> Column:
    return F.filter(_col(symbols), lambda s: F.array_contains(known, s))


def words_of_segments(segments: Column | str) -> Column:
    """The words (word, start, end) of nested recogniser segments as one list."""
    return F.flatten(F.transform(_col(segments), lambda s: F.coalesce(s["words"], F.array().cast("array<struct<word: string, start: double, end: double>>"))))


def segment_start(length: Column, size: int, seed: int, *key: str) -> Column:
    """A start at which a segment of ``size`` fits, stable by key and seed."""
    room = F.greatest(length - size + 1, F.lit(1))
    return F.pmod(F.xxhash64(*key, F.lit(seed)), room).cast("int")
