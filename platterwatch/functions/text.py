"""Text helpers for lines in and lines out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_field(fields: Column, position: int) -> Column:
    """Field of a split line, null where the line is too short."""
    return F.get(fields, F.lit(position))


def text_of(value: Column) -> Column:
    """A value as text, null as an empty one."""
    return F.coalesce(value.cast("string"), F.lit(""))


def fixed(value: Column, digits: int = 3) -> Column:
    """Fixed number of decimals, rounded half up, without thousands separators.

    Noise of the summation order beyond six more digits is rounded off first, so that the text
    does not depend on how the rows were partitioned. Null gives an empty text.
    """
    text = F.format_string(f"%.{digits}f", F.round(value, digits + 6))
    return F.when(value.isNull(), "").otherwise(text)


def pair_text(entry: Column, fields: tuple[str, ...]) -> Column:
    """The fields of a struct, joined by commas; null fields are empty and keep their place."""
    return F.concat_ws(",", *[text_of(entry[name]) for name in fields])


def joined(entries: Column, fields: tuple[str, ...]) -> Column:
    """A list of structs as one comma-joined text."""
    return F.array_join(F.transform(entries, lambda entry: pair_text(entry, fields)), ",")
