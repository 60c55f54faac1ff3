"""Review-safety analytics as PySpark DataFrame jobs."""
