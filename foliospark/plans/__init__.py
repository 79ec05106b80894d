"""Whole jobs composed from the operators, and the named queries over the given tables."""

from importlib import import_module

FAMILIES = ("scans", "scalars", "splitting", "retrieval", "metrics", "chats", "learning", "streams", "lifecycle")


def load_queries():
    """Import every query family and return the registry module."""
    registry = import_module("foliospark.plans.registry")
    for family in FAMILIES:
        import_module(f"foliospark.plans.{family}_queries")
    return registry
