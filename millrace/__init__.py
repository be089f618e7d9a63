"""PySpark jobs for everyday data-engineering work."""
