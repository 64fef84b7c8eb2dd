"""Access-governance and device-telemetry analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
