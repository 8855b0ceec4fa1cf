"""examlytics: assessment analytics as Spark DataFrame jobs.

Layers:
  sources/    lake readers and writers, incremental extract, silver tables
  functions/  scalar Column expressions (text, dates, buckets, percentages)
  operators/  reusable DataFrame operators (dedup, windows, joins, slicers, JSON)
  plans/      analytical views, marts, candidate profiles, medallion jobs
  streaming/  Structured Streaming form of the incremental extract
"""

__version__ = "0.1.0"
