"""Event replay and equipment-trace analytics as plain Spark DataFrame jobs."""

from pulsetrail.config import ReplayConfig, Sink

__all__ = ["ReplayConfig", "Sink"]
