"""Importing this module registers every query."""

from engrama.plans import graph_queries, index_queries, ingest_queries, memory_queries, stream_queries, text_queries, vector_queries  # noqa: F401
from engrama.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
