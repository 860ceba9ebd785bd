"""Engrama: agent-memory storage and vector-retrieval work expressed as Spark jobs."""

__version__ = "0.1.0"
