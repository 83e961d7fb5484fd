"""auric: a retail medallion lakehouse (bronze -> silver -> gold) on PySpark.

Layers are plain functions over DataFrames: ``auric.operators`` (dedup, data
quality, silver, gold, history, enrichment), ``auric.plans`` (the batch job,
reports, metrics, named queries), ``auric.sources`` / ``auric.sinks`` (files
and tables), ``auric.streaming`` (incremental landing).
"""

__version__ = "0.1.0"
