"""Free-text note de-identification as Spark DataFrame jobs."""
