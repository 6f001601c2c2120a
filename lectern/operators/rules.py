"""Rules over rows: first-failing cascades, multi-label issues, verdicts and outcomes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions import text as T


@dataclass(frozen=True)
class Rule:
    """A name, when it fires, and what to say then."""

    name: str
    fires: Column
    details: Column | None = None


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that fires, null for a row that passes; one expression, no pass per rule."""
    return F.coalesce(*[F.when(r.fires, F.lit(r.name)) for r in rules])


def multilabel(df: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    """A row (``keep``, issue, details, position) for each rule that fires, in a single scan."""
    found = F.array(*[F.when(r.fires, F.struct(F.lit(r.name).alias("issue"), (r.details if r.details is not None else F.lit("")).alias("details"), F.lit(i).alias("position"))) for i, r in enumerate(rules)])
    return df.select(*keep, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("_f")).select(*keep, "_f.*")


def filter_rules(wav: str, text: str, duration: str, min_duration: float = 2.0, max_duration: float = 15.0, min_chars: int = 6, max_chars: int = 400, drop_regex: str = r"(?U)^[\W_]+$", columns: str | None = None, exists: str | None = None) -> list[Rule]:
    """The drop rules of a dataset filter, in order."""
    size = F.length(text)
    return [
        *([Rule("bad_row", F.col(columns) < 2)] if columns else []),
        Rule("empty_wav", F.coalesce(F.col(wav), F.lit("")) == ""),
        *([Rule("missing_wav", ~F.col(exists))] if exists else []),
        Rule("invalid_wav", F.col(duration).isNull()),
        Rule("too_short", F.col(duration) < min_duration),
        Rule("too_long", F.col(duration) > max_duration),
        Rule("text_too_short", size < min_chars),
        Rule("text_too_long", size > max_chars),
        Rule("text_regex", F.col(text).rlike(drop_regex)),
    ]


def text_rules(text: str, min_len: int = 3, max_len: int = 400, min_share: float = 0.6, primary: str = T.CYRILLIC, secondary: str = T.LATIN, strict: bool = False) -> list[Rule]:
    """Printability, length and script. ``strict`` flags texts without letters too, as a validator does."""
    a, b = T.letter_count(text, primary), T.letter_count(text, secondary)
    # Counted shares are compared by products, so no rounding decides.
    low = (a < min_share * (a + b)) | ((a + b == 0) if strict else F.lit(False))
    size = F.length(text)
    return [
        Rule("non_printable", F.col(text).rlike(T.NON_PRINTABLE)),
        Rule("too_short_text", size < min_len, F.concat(F.lit("len="), size)),
        Rule("too_long_text", size > max_len, F.concat(F.lit("len="), size)),
        Rule("low_script_share", low, F.concat(a.cast("string"), F.lit("/"), (a + b).cast("string"))),
    ]


def audio_rules(channels: str, subtype: str, rate: str, duration: str, expected_rate: int, least: float = 0.2) -> list[Rule]:
    """Format checks of audio headers."""
    return [
        Rule("not_mono", F.col(channels) != 1),
        Rule("not_pcm16", F.col(subtype) != "PCM_16"),
        Rule("sample_rate_mismatch", F.col(rate) != expected_rate),
        Rule("too_short", F.col(duration) <= least),
    ]


def dropped_by_verdict(verdict: Column, drop: tuple[str, ...] = ("bad", "missing")) -> Column:
    """True for the named verdicts in any case; unknown rows are kept."""
    return F.coalesce(F.lower(verdict).isin(*drop), F.lit(False))


def choose_text(policy: str, cutlist: Column, aligned: Column) -> Column:
    """``cutlist``, ``to_align`` (null where there is none) or ``auto`` (the cutlist text as a fallback)."""
    return {"cutlist": cutlist, "to_align": aligned, "auto": F.coalesce(aligned, cutlist)}[policy]


def overall_verdict(counts: dict[str, Column]) -> Column:
    """FAIL if any of the global counts is above zero."""
    total = sum((c for c in list(counts.values())[1:]), list(counts.values())[0])
    return F.when(total > 0, F.lit("FAIL")).otherwise(F.lit("PASS"))


def first_edit(old: Column, new: Column, original: Column) -> Column:
    """The text to keep as the original: the first one that was edited away."""
    return F.when(original.isNull() & (new != old), old).otherwise(original)


def with_status(df: DataFrame, status: str, mode: str = "all") -> DataFrame:
    """Rows of one status, or ``all``."""
    return df if mode == "all" else df.filter(F.col(status) == mode)


def whitelisted(df: DataFrame, wanted: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and a struct ``meta`` of the wanted columns that the table has."""
    return df.select(*keep, F.struct(*[c for c in wanted if c in df.columns]).alias("meta"))
