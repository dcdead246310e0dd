"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when a cell is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing white space, Unicode included (``trim`` drops blanks only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def file_name(path: Column) -> Column:
    """Last part of a file path, as Spark reports it: percent-encoded, but plus signs are not."""
    last = F.substring_index(path, "/", -1)
    return F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))
