"""tidemark — order-stream analytics expressed as Spark DataFrame plans.

Sub-packages:
  sources    readers/writers: test-data adapter, generators, append log, upsert tables, lifecycle
  functions  column expressions and fixed rule tables
  operators  DataFrame -> DataFrame transforms (enrich, windows, alerts, analytics, quality, observe)
  plans      named queries over a data directory and their DuckDB oracle SQL
  streaming  Structured Streaming jobs built from the same transforms
"""

__version__ = "0.1.0"
