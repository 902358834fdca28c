"""millrace: a PySpark engine that turns web pages into a clean, chunked retrieval corpus."""
