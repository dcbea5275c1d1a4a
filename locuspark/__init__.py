"""locuspark: association-mapping benchmark analytics as Spark DataFrame jobs."""
