"""Event analytics on PySpark: DataFrame operators for bounded and streaming input."""
