"""Functions on slot-aligned arrays: slot i of the output belongs to slot i of the input, null if it has no match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = " | "


def join_list(c: Column) -> Column:
    """Slots joined by ` | `, a null slot as an empty one; a null list gives an empty text."""
    return F.coalesce(F.array_join(c, SEPARATOR, ""), F.lit(""))


def list_length(c: Column) -> Column:
    return F.coalesce(F.size(F.coalesce(c, F.array().cast("array<string>"))), F.lit(0)).cast("long")


def n_matched(c: Column) -> Column:
    return F.coalesce(F.size(F.array_compact(c)), F.lit(0)).cast("long")


def count_value(c: Column, value: str) -> Column:
    return F.coalesce(F.size(F.filter(c, lambda x: x == value)), F.lit(0)).cast("long")


def field_of(slots: Column, field: str) -> Column:
    """One field of an array of slot structs."""
    return F.transform(slots, lambda s: s[field])
