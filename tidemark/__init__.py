"""Event analytics on Spark: ingest, typed events, sessions, attribution, rollups, serving queries and checks."""
