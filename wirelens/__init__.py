"""Network wire telemetry and training-data analytics as Spark DataFrame jobs."""
