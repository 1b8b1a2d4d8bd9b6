"""tillbook — retail analytics and data-quality jobs written as Spark DataFrame plans.

Layout:
  functions/  column expressions (money, dates, text, percentages)
  sources/    table loaders, CSV dialects, file listing, versioned snapshots, sinks
  operators/  reusable DataFrame -> DataFrame operators (profiling, validation,
              dedup, SCD1/SCD2 merges, schema drift, global windows, defects)
  plans/      the named business queries, each paired with an oracle SQL text
  streaming/  incremental (file-stream) form of the bronze ingest
"""

__version__ = "0.1.0"
