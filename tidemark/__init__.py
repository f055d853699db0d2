"""Change-data lakehouse, hash-keyed vault, marts and data quality as Spark DataFrame jobs."""
