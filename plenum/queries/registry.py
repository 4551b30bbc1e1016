"""All queries of the library, by name, each beside the SQL that it must agree with."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame and its SQL."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _load() -> None:
    from . import checks, nested, reviews, texts, votes  # noqa: F401  they register themselves


def flagship(spark, sf_dir):
    """Where the best record of a group differs from what most records say."""
    _load()
    return QUERIES["vote_diff"](spark, sf_dir)


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
