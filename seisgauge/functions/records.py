"""Text records, messages and hash bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record(*fields: Column | str) -> Column:
    """Comma-joined record. A NULL field prints as nothing but keeps its comma."""
    parts: list[Column] = []
    for field in fields:
        column = F.lit(field) if isinstance(field, str) else field
        if parts:
            parts.append(F.lit(","))
        parts.append(F.coalesce(column.cast("string"), F.lit("")))
    return F.concat(*parts)


def message(*parts: Column | str) -> Column:
    """Concatenated text; one NULL part makes the whole message NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def display_name(display: Column, name: Column) -> Column:
    return F.coalesce(display, name, F.lit("No name"))


def hash_bytes(hex_text: Column) -> Column:
    """Bytes of a hex digest; NULL if it is not whole bytes of hex."""
    return F.when(F.length(hex_text) % 2 == 0, F.unhex(hex_text))
