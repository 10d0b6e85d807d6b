"""PySpark-native match-telemetry integrity engine."""
