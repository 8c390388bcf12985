"""spanlake: telemetry analytics (traces, logs, metrics) on PySpark."""
