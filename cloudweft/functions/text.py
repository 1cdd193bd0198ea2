"""String rules for object keys, file names and account ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The longest job name and what an empty one becomes.
NAME_CHARS = 64
DEFAULT_NAME = "job"


def sanitised(name: Column) -> Column:
    """Letters, digits, - and _ stay, other characters become _; at most 64 characters, never empty."""
    plain = F.left(F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_"), F.lit(NAME_CHARS))
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit(DEFAULT_NAME))


def last_segment(key: Column) -> Column:
    return F.substring_index(F.replace(key, F.lit("\\"), F.lit("/")), "/", -1)


def usable_segment(segment: Column) -> Column:
    return ~segment.isin("", ".", "..")


def is_account_id(value: Column) -> Column:
    return value.rlike(r"\A[0-9a-f]{32}\z")


def stripped(value: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(value, r"^[\p{IsWhite_Space}]+|[\p{IsWhite_Space}]+$", "")


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?/?$", 1)


def numbered(index: Column, width: int) -> Column:
    return F.lpad(index.cast("string"), width, "0")


def inside(base: Column, name: Column) -> Column:
    """Whether ``name`` stays below ``base``: neither absolute nor with a .. step, as far as text can tell."""
    parts = F.split(F.replace(name, F.lit("\\"), F.lit("/")), "/")
    return (name != "") & ~name.startswith("/") & ~F.array_contains(parts, "..") & base.isNotNull()
