"""Small text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_only(c: Column) -> Column:
    """Without all characters outside ASCII; null counts as empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\x00-\x7F]", "")


def place(text: Column, item: Column) -> Column:
    """Where item first stands in text, from 1; 0 if it doesn't."""
    return F.coalesce(F.position(item, text), F.lit(0))


def around(text: Column, item: Column, width: int = 30) -> Column:
    """item's first place with `width` characters on either side; null if it isn't there."""
    at = place(text, item)
    start = F.greatest(at - width, F.lit(1))
    return F.when(at > 0, F.substring(text, start, at + F.length(item) + width - start))


def capped(c: Column, n: int) -> Column:
    """The first n characters, where a result is defined on them alone (previews, prompts)."""
    return F.left(c, F.lit(n))


def singular(c: Column) -> Column:
    """Without the final s of a plural."""
    return F.regexp_replace(c, "s+$", "")
