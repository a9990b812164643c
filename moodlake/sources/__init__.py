"""Where posts come from: CSV files, the broker, the enriched store."""
