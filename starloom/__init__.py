"""Star-schema ETL, quality checks and analytics as plain PySpark DataFrame code."""
