"""Text functions: Column in, Column out, all inside the JVM.

White space is taken in the Unicode sense (``(?U)\\s``) unless noted.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACES = r"(?U)\s+"
#: Letters of the primary and the secondary script, as regular-expression classes (fixed values).
CYRILLIC = "[А-Яа-яЁё]"
LATIN = "[A-Za-z]"
#: Control characters that no transcript may hold (fixed value).
NON_PRINTABLE = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Column | str) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(_col(c), SPACES, " ")


def normalize_compare(c: Column | str) -> Column:
    """The form in which texts are compared: lower case, letters of two scripts and digits, single spaces."""
    return strip(squeeze(F.regexp_replace(F.lower(_col(c)), r"(?U)[^a-zа-яё0-9\s]", " ")))


def normalize_store(c: Column | str) -> Column:
    """The form in which texts are stored in pipe-delimited files."""
    return strip(squeeze(F.translate(_col(c), "\r\n|", "   ")))


def clean_text(c: Column | str) -> Column:
    """Manifest cleaning. Bars become spaces after the squeeze, so double spaces can remain."""
    out = F.regexp_replace(squeeze(c), r" ([.,!?;:])", "$1")
    return strip(F.translate(F.replace(out, F.lit(" - "), F.lit(" — ")), "|", " "))


def safe_out_name(c: Column | str, default: str = "utt") -> Column:
    """A file name for a free text, ``<default>.wav`` if nothing is left."""
    out = F.regexp_replace(F.replace(strip(c), F.lit(" "), F.lit("_")), r"[^0-9A-Za-z._-]+", "_")
    out = F.regexp_replace(F.regexp_replace(out, "_+", "_"), "^_+|_+$", "")
    out = F.coalesce(F.nullif(out, F.lit("")), F.lit(default))
    return F.when(F.lower(out).endswith(".wav"), out).otherwise(F.concat(out, F.lit(".wav")))


def is_boundary(c: Column | str) -> Column:
    """Does the text end with a sentence mark, closing quotes and brackets aside?"""
    return strip(c).rlike(r"""[.!?…]+["')\]]*$""")


def name_prefix(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), r"(?i)^(.+?)_(\d+)\.wav$", 1), F.lit(""))


def name_segment(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), r"(?i)^(.+?)_(\d+)\.wav$", 2), F.lit("")).cast("int")


def punctuation_only(c: Column | str) -> Column:
    return _col(c).rlike(r"(?U)^[\W_]+$")


def tokens(c: Column | str) -> Column:
    """Words between white space; none for an empty text."""
    return F.filter(F.split(_col(c), SPACES), lambda t: t != "")


def sentences(c: Column | str) -> Column:
    """Parts that end with a sentence mark before white space; a rule of our own, not a trained segmenter."""
    return F.filter(F.split(F.regexp_replace(_col(c), r"([.!?…])\s+", "$1\u0001"), "\u0001"), lambda s: F.trim(s) != "")


def strip_flags(c: Column | str) -> Column:
    """Without language flags in round brackets."""
    return F.regexp_replace(_col(c), r"\([^)]+\)", "")


def raw_blocks(c: Column | str) -> Column:
    """Text cut before and after ``[[ ... ]]`` blocks, which stay as parts of their own."""
    marked = F.regexp_replace(_col(c), r"(\[\[.*?\]\])", "\u0001$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda p: p != "")


def cache_id(row: Column | str, text: Column | str, speaker: Column | str | None = None, most: int = 50) -> Column:
    """Row, speaker and a sanitised text, cut to ``most`` characters."""
    clean = F.regexp_replace(_col(text), r"[^0-9A-Za-z._ -]+", "")
    parts = [_col(row).cast("string"), *([_col(speaker)] if speaker is not None else []), clean]
    return F.left(F.concat_ws("_", *parts), F.lit(most))


def voice_name(c: Column | str) -> Column:
    """Struct of family, region, name and quality of ``ll_RR-name-quality``."""
    pattern = r"^([^-_]+)_([^-_]+)-([^-]+)-([^-]+)$"
    part = lambda i: F.nullif(F.regexp_extract(_col(c), pattern, i), F.lit(""))
    return F.struct(part(1).alias("lang_family"), part(2).alias("lang_region"), part(3).alias("voice_name"), part(4).alias("voice_quality"))


def option_set(c: Column | str) -> Column:
    """The distinct lower-case values of a comma-separated list, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(_col(c), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")))


def html_escape(c: Column | str) -> Column:
    out = _col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def plain_dashes(c: Column | str) -> Column:
    return F.translate(_col(c), "—–", "--")


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def first_code_point(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 1)


def letter_count(c: Column | str, letters: str) -> Column:
    return F.regexp_count(_col(c), F.lit(letters))


def script_share(c: Column | str, primary: str = CYRILLIC, secondary: str = LATIN) -> Column:
    """Share of primary-script letters among letters of both scripts; null without letters."""
    a, b = letter_count(c, primary), letter_count(c, secondary)
    return F.when(a + b > 0, a / (a + b))


def code_switch(c: Column | str, primary: str = CYRILLIC, secondary: str = LATIN, least: float = 0.1) -> Column:
    """Both scripts present and the secondary one with at least the share ``least``."""
    a, b = letter_count(c, primary), letter_count(c, secondary)
    return (a > 0) & (b > 0) & (b / (a + b) >= least)


def mode_count(words: Column | str) -> Column:
    """How often the most frequent element of an array occurs, by a fold over the sorted array."""
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, w: Column) -> Column:
        run = F.when(w == acc.last, acc.run + 1).otherwise(F.lit(1))
        return F.struct(w.alias("last"), run.alias("run"), F.greatest(acc.best, run).alias("best"))

    return F.aggregate(F.array_sort(_col(words)), start, step, lambda acc: acc.best)


def mode_share(words: Column | str, least: int = 6) -> Column:
    """Share of the most frequent word; 0 for fewer than ``least`` words."""
    n = F.size(_col(words))
    return F.when(n < least, F.lit(0.0)).otherwise(mode_count(words) / n)
