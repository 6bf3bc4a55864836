"""Spark-first analytics for address coverage: registers, claim arbitration, name resolution, geometry and deltas."""

__version__ = "0.1.0"
