"""tidemark — a Spark-native engine for a multi-source market-data store.

Every operator is a plain ``DataFrame -> DataFrame`` function built on Spark's
own joins, windows and aggregates. Only the load jobs
(:mod:`tidemark.plans.jobs`) write, through the stores in
:mod:`tidemark.sources.tables`.
"""

__version__ = "0.1.0"
