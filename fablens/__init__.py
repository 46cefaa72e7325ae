"""Quality and yield analytics as Spark DataFrame jobs."""
