"""Text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode White_Space, spelled out because Java's \s is ASCII only.
WHITE = "\t\n\x0b\f\r \x85\xa0 " + "".join(chr(c) for c in range(0x2000, 0x200B)) + "    　"


def rstrip(c: Column) -> Column:
    """``c`` without white space at its end (linear, unlike a regular expression)."""
    return F.rtrim(c, F.lit(WHITE))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE))
