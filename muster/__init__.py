"""Fleet assignment analytics as Spark DataFrame jobs."""
