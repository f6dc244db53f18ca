"""strata: a medallion (Bronze / Silver / Gold) questionnaire pipeline and categorical
analytics, written as Spark DataFrame and SQL plans.

Layers:
  sources/    raw JSONL lines, Silver CSV and Gold files in
  operators/  ingestion, cleaning and serving operators (DataFrame in, DataFrame out)
  functions/  column expressions (strict strip, Python-style title case, flags, text formats)
  plans/      the SQL face, the RDD face, face comparison and the end-to-end pipeline
  sinks/      writers for Parquet, CSV and JSON, output sizes
  streaming/  incremental Bronze ingestion with Structured Streaming
"""

__version__ = "0.1.0"
