"""sevscope — incident-severity analytics as Spark DataFrame jobs.

Sub-packages:
  sources    scans of raw report extracts and the derived fixture view, sinks
  functions  column expressions (label rules, narrative patterns, formatting)
  operators  DataFrame -> DataFrame building blocks (dedup, consolidation, metrics, ...)
  plans      end-to-end jobs (cleaning, models, clustering) and the query catalogue
  streaming  incremental ingestion of newly dropped extracts
"""

__version__ = "0.1.0"
