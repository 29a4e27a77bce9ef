"""Sizes, durations and timestamps as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.constants import EXCEPTION_PATTERNS


def format_file_size(size: Column) -> Column:
    """B, KB, MB, GB or TB with one decimal (halves to even), in steps of 1024."""
    out, value = None, size.cast("double")
    for unit in ("B", "KB", "MB", "GB"):
        text = F.format_string(f"%.1f {unit}", F.bround(value, 1))
        out = F.when(value < 1024, text) if out is None else out.when(value < 1024, text)
        value = value / 1024
    return out.otherwise(F.format_string("%.1f TB", F.bround(value, 1)))


def format_duration(seconds: Column) -> Column:
    """Seconds below a minute, minutes and seconds below an hour, else hours and minutes."""
    s = seconds.cast("double")
    whole = F.floor(s).cast("long")
    return (
        F.when(s < 60, F.format_string("%.1fs", F.bround(s, 1)))
        .when(s < 3600, F.format_string("%dm %ds", F.floor(whole / 60), whole % 60))
        .otherwise(F.format_string("%dh %dm", F.floor(whole / 3600), F.floor((whole % 3600) / 60)))
    )


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def timestamp_folder(ts: Column) -> Column:
    return F.date_format(ts, "dd-MM-yy-HH-mm-ss")


def matches_exception(text: Column, patterns: tuple[str, ...] = EXCEPTION_PATTERNS) -> Column:
    """Whether any pattern occurs in the lower-cased text."""
    if not patterns:
        return F.lit(False)
    low = F.lower(text)
    # one array of literals: as many terms joined by "or" would be too deep a tree for long lists
    return F.exists(F.array(*(F.lit(p.lower()) for p in patterns)), lambda p: F.contains(low, p))
