"""Text, lookup and coercion expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


#: The characters of the Unicode property White_Space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trimmed(column: str | Column) -> Column:
    return F.trim(_col(column))


def lowered(column: str | Column) -> Column:
    return F.lower(F.trim(_col(column)))


def uppered(column: str | Column) -> Column:
    return F.upper(F.trim(_col(column)))


def strip(column: Column) -> Column:
    """Remove every kind of white space at both ends, line breaks and Unicode spaces included."""
    return F.btrim(column, F.lit(SPACES))


def lookup(column: str | Column, table: Mapping[str, object]) -> Column:
    """Value of a small literal dictionary, null for an unknown key."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), _col(column))


def nth(values: Sequence[object], index: Column) -> Column:
    """Entry of a literal list by zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
