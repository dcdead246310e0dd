"""Lenient numeric casts: text that is no number becomes NULL, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import MONEY


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_int(value: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Integer part of a number; text such as ``12.7`` gives 12, ``20x3`` gives NULL.

    ``dtype`` is the type of ``value``. A plain ``try_cast`` of ``'12.7'`` would be NULL.
    """
    if isinstance(dtype, T.StringType):
        whole = F.regexp_extract(value, r"^\s*([+-]?\d+)(?:\.\d*)?\s*$", 1)
        return whole.try_cast("int")
    return value.try_cast("int")


def leading_number(text: Column) -> Column:
    """Digits at the start of a damaged number: ``692,extra`` gives 692.0, ``-5`` gives NULL."""
    return F.regexp_extract(text, r"^(\d+)", 1).try_cast("double")


def to_money(value: Column) -> Column:
    """Two-decimal amount for tables at rest.

    The cast is the strict one: an amount beyond ``decimal(18,2)`` stops the load
    instead of silently turning into NULL.
    """
    return to_double(value).cast(MONEY)
