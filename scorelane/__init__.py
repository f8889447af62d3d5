"""Match-data analytics on PySpark: page parsing, keyed state, ratings and streaming ingest."""
