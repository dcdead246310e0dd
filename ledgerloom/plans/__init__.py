"""Reporting views, the date dimension and the batch run."""
