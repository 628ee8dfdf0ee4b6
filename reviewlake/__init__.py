"""Customer-review analytics on PySpark."""
