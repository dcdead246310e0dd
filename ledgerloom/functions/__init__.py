"""Column expressions shared by readers and operators. All stay inside the JVM."""

from ledgerloom.functions.numbers import leading_number, to_double, to_int, to_money
from ledgerloom.functions.text import blank_to_null, file_name, strip

__all__ = [
    "blank_to_null", "file_name", "leading_number", "strip", "to_double", "to_int", "to_money",
]
