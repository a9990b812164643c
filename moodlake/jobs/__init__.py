"""Programs for spark-submit: ingest, enrich, train, report."""
