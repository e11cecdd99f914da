"""Change-stream analytics on PySpark."""
