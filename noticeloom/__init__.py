"""Notice analytics on PySpark: captured portal pages to clean, deduplicated records."""
