"""Queries over the given tables, one module per operator family."""

from importlib import import_module

from granary.plans.registry import REGISTRY, Query

_MODULES = (
    "scans",
    "projections",
    "joins",
    "aggregates",
    "windows",
    "ordering",
    "scalars",
    "texts",
    "encodings",
    "features",
    "learning",
    "metrics",
    "streams",
    "extensions",
)


def catalog() -> dict[str, Query]:
    for module in _MODULES:
        import_module(f"granary.plans.{module}")
    return dict(REGISTRY)
