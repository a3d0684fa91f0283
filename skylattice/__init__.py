"""Weather analytics as Spark DataFrame jobs."""
