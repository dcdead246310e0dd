"""Spark operators for building a small financial warehouse.

Every operator is a plain ``DataFrame -> DataFrame`` function and starts no job;
only the sinks and :func:`ledgerloom.plans.batch.run` do.
"""
