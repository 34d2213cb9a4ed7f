"""pulse: live activity metrics over wiki edit-event streams, on Spark."""

__version__ = "0.1.0"
