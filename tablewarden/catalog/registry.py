"""A small register for named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Register:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
        def add(fn: Callable) -> Callable:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if sql:
                self.sql[name] = sql
            return fn

        return add
