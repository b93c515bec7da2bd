"""Registered queries over the given tables, each with its SQL where one exists."""

from importlib import import_module

MODULES = ("relational", "capture", "applog", "quality", "scalars", "streams")


def load_all():
    """(queries, SQL) of every check module."""
    from tidemart.checks import registry

    for module in MODULES:
        import_module(f"tidemart.checks.{module}")
    return registry.QUERIES, registry.SQL
