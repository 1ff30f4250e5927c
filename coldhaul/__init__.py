"""Fleet telemetry and cold-chain analytics as Spark DataFrame operators."""
