"""How a plan module registers its queries: a name, the operators it shows and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    """``queries``: name to callable; ``oracles``: name to SQL; ``shows``: name to the operator ids of the survey."""

    def __init__(self, prelude: str = ""):
        self.prelude = prelude
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}
        self.shows: dict[str, tuple[str, ...]] = {}

    def query(self, shows: str, sql: str | None = None):
        """Register the decorated function under its own name; ``sql`` follows the module's common table expressions."""

        def add(fn):
            name = fn.__name__
            if name in self.queries:
                raise ValueError(f"query name used twice: {name}")
            self.queries[name] = fn
            self.shows[name] = tuple(shows.split())
            if sql is not None:
                body = sql.strip()
                head = self.prelude
                if head and body.upper().startswith("WITH RECURSIVE "):
                    body = f"WITH RECURSIVE {head[5:]}, {body[15:]}"
                elif head:
                    body = f"{head}, {body[5:]}" if body.upper().startswith("WITH ") else f"{head} {body}"
                self.oracles[name] = body
            return fn

        return add
