"""courtline: play-by-play analytics as plain Spark DataFrame functions.

Layers:
  sources/    scans, fixtures derived from the test tables, catalog round trips
  functions/  column expressions and fixed values
  operators/  medallion pipeline, windows, quality checks, analyst queries,
              profiles, features, regression models
  plans/      the query registry and its DuckDB oracle SQL, pipeline runner
  streaming/  incremental ingestion of season files into bronze
"""

__version__ = "0.1.0"
