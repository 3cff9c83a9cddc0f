"""All registered queries."""

from functools import wraps
from importlib import import_module

from weeksignal.session import ship_package

_MODULES = [
    "feature_queries", "eda_queries", "evaluation_queries", "text_queries", "source_queries",
    "linking_queries", "model_queries", "streaming_queries",
]


def _registries():
    return [import_module(f"weeksignal.catalog.{name}").reg for name in _MODULES]


def _shipping(fn):
    @wraps(fn)
    def run(spark, folder):
        ship_package(spark)
        return fn(spark, folder)

    return run


def all_queries() -> dict:
    return {name: _shipping(fn) for reg in _registries() for name, fn in reg.queries.items()}


def all_sql() -> dict:
    return {name: sql for reg in _registries() for name, sql in reg.sql.items()}
