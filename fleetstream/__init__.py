"""Fleet telemetry analytics on Spark DataFrames and Structured Streaming."""

from fleetstream.config import FleetConfig

__all__ = ["FleetConfig"]
