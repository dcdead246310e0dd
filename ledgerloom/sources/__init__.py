"""Source readers and their registry."""

from ledgerloom.sources.registry import READERS, Extract, Reader, extract, reader_for

__all__ = ["READERS", "Extract", "Reader", "extract", "reader_for"]
