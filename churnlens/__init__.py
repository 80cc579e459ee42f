"""churnlens: subscription-churn analytics as Spark jobs.

Layers (bronze -> silver -> gold):
  sources/    raw CSV reader with explicit schemas, test-data adapter, silver readers
  functions/  column expressions (text, numbers, dates, buckets) - all JVM-side
  operators/  profiling, cleaning, customer features, churn reports
  plans/      the batch job, Spark SQL twins of the report queries, plan checks
  sinks/      Parquet / CSV / JSON writers
  streaming/  incremental ingest of raw file drops with Structured Streaming
"""

from churnlens.params import ChurnParams

__all__ = ["ChurnParams"]
