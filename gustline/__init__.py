"""Wind-farm telemetry analytics as Spark DataFrame operators."""
