"""Map and struct functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def public_entries(m: Column | str) -> Column:
    """Without the keys that start with an underscore."""
    return F.map_filter(_col(m), lambda k, v: ~k.startswith("_"))


def sorted_keys(m: Column | str) -> Column:
    return F.array_sort(F.map_keys(_col(m)))


def inverted(m: Column | str) -> Column:
    """Values to keys; values must be distinct."""
    return F.map_from_entries(F.transform(F.map_entries(_col(m)), lambda e: F.struct(e.value, e.key)))


def with_default(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def upsert(record: str, path: str, value: Column) -> Column:
    """The struct column with one nested field set and its siblings kept."""
    return F.col(record).withField(path, value)
