"""Queries that run the operators over whole test tables, with an SQL check for each."""
