"""News and trade analytics on PySpark: lakes, retrieval, guarded SQL, streams."""
