"""ledgerlake: banking lakehouse analytics as ordinary PySpark DataFrame jobs."""
