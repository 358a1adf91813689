"""pricemart: a PySpark-native library for monthly price intelligence.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function.
Planning, shuffles and execution are left to Spark (Catalyst + AQE).

Sub-packages:
  functions/  native Column expressions (text cleaning, dates, exact rounding, HTML text)
  sources/    readers: JSON envelopes, API payloads, CSV header aliases, HTML tables, cascades
  operators/  table operators: dedupe, fill, resample, merge, change, keys, quality
  plans/      composite jobs: the transform, the star schema, the view, ingest jobs
  sinks/      writers: snapshots, warehouse tables, insert-if-empty
  streaming/  incremental pick-up of landed snapshots (Structured Streaming)
"""

__version__ = "0.1.0"
