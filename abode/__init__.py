"""abode: a Spark-native engine for home-listing snapshots and price comparisons.

Subpackages:
  functions  column expressions (address, price, bins, texts, stable hashes)
  sources    readers (JSON lines, Parquet snapshots, JDBC, supplied tables)
  sinks      writers (Parquet snapshots, JSON lines, JDBC)
  operators  enrichment, snapshot changes, churn sampling, comparison reports
  plans      composite plans (batch run), size-checked broadcast, lineage cuts
  streaming  incremental ingest of newly arrived batch files
"""
