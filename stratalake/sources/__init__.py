"""CSV ingestion, load history, and the snapshot table store."""
