"""Expressions over source fields used by the table definitions.

Every function takes and returns raw text Columns; typing happens afterwards in ``decode``.
The marker texts are names inside the exporting system, so they are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROOT = "Primary"
NOT_APPLICABLE = "Not Applicable"
UNKNOWN = "Unknown"


def blank(raw: Column) -> Column:
    return raw.isNull() | (F.trim(raw) == "")


def blank_root(raw: Column, root: str = ROOT) -> Column:
    """The root of a hierarchy has no parent."""
    # the marker may be preceded by a control character in exports
    return F.when(F.regexp_replace(raw, r"^[^A-Za-z]+", "") == root, "").otherwise(raw)


def blank_not_applicable(raw: Column, marker: str = NOT_APPLICABLE) -> Column:
    return F.when(raw.isNull() | F.trim(raw).endswith(marker), "").otherwise(raw)


def blank_unknown(raw: Column, marker: str = UNKNOWN) -> Column:
    return F.when(F.trim(raw).endswith(marker), "").otherwise(raw)


def joined(values: Column, delimiter: str = ", ") -> Column:
    """A repeated value as one text."""
    return F.concat_ws(delimiter, values)


def formatted(pattern: str, present: Column, *args: Column) -> Column:
    """``printf`` of the arguments when ``present`` is non-blank, else ''."""
    filled = [F.coalesce(a, F.lit("")) for a in args]
    return F.when(blank(present), "").otherwise(F.format_string(pattern, *filled))


def first_or_last_of(own: Column, entries: Column, name: str) -> Column:
    """``own`` if non-blank, else ``name`` of the last entry of a nested list."""
    return F.when(blank(own), nth(entries, -1).getField(name)).otherwise(own)


def nth(entries: Column, position: int) -> Column:
    """The entry at a 1-based position (negative from the end), NULL beyond the list."""
    index = F.lit(position - 1) if position > 0 else F.size(entries) + position
    return F.get(entries, index)


def replace_first(raw: Column, find: str, put: str = "") -> Column:
    """Replace only the first occurrence of a text."""
    at = F.locate(find, raw)
    head = F.substring(raw, F.lit(1), at - 1)
    tail = F.substring(raw, at + len(find), F.length(raw))
    return F.when(at > 0, F.concat(head, F.lit(put), tail)).otherwise(raw)
