"""Business-table cleaning and recurring analytics as Spark DataFrame jobs."""
