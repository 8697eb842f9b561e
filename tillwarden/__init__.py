"""Payment fraud analytics on PySpark: scoring rules, layered tables, streams."""
