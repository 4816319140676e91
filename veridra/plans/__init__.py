"""Queries over the synthetic tables; loading this package's modules registers them."""

from importlib import import_module

MODULES = ("scalar_queries", "link_queries", "relational_queries", "graph_queries", "file_queries", "more_queries", "evidence_queries", "ingest_queries")


def load() -> None:
    for name in MODULES:
        import_module(f".{name}", __name__)
