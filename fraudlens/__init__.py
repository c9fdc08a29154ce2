"""Card-fraud analytics as Spark DataFrame, Structured Streaming and MLlib jobs."""
