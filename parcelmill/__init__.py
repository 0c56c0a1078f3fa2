"""CDC-to-analytics library for PySpark: Bronze, Silver, Gold, metrics and row-level security."""
