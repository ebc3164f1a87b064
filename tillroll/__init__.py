"""tillroll: retail customer analytics expressed as Spark DataFrame operators.

Modules:
  sources/    scans, fixture views, sinks, run tracking, model persistence
  functions/  column-expression helpers (dates, rounding, lookups)
  operators/  DataFrame -> DataFrame operators (profile, clean, features, EDA,
              RFM, sampling, clustering metrics, segments, baskets, classifier)
  plans/      the end-to-end steps and the query registry used by the checks
  streaming/  request validation and scoring, batch and Structured Streaming
"""

__version__ = "0.1.0"
