"""Daily market-volume analytics as Spark jobs."""
