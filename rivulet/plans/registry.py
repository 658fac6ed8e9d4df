"""Registry of named queries over the driver tables, each with optional oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    make_sql: str | Callable[[], str] | None
    operator: str  # SURVEY id(s), e.g. "G2"

    @property
    def sql(self) -> str | None:
        """Oracle SQL, built when asked for so that one failing builder cannot stop the others from loading."""
        return self.make_sql() if callable(self.make_sql) else self.make_sql


_REGISTRY: dict[str, Entry] = {}


def query(name: str, operator: str, sql: str | Callable[[], str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    Registering the same function again (a module imported anew) replaces its entry.
    """
    def deco(fn: QueryFn) -> QueryFn:
        old = _REGISTRY.get(name)
        if old and (old.fn.__module__, old.fn.__qualname__) != (fn.__module__, fn.__qualname__):
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, sql, operator)
        return fn
    return deco


def entries() -> dict[str, Entry]:
    from . import catalog  # noqa: F401  (registers everything)
    return dict(_REGISTRY)
