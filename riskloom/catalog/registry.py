"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.catalog.views import VIEWS
from riskloom.plans.lake import Lake
from riskloom.sources.bronze import BRONZE, oracle_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _view_text(name: str) -> str:
    return oracle_text(name) if name in BRONZE else VIEWS[name]


def with_views(select: str) -> str:
    """The statement with every view it uses, directly or through others, as common table expressions."""
    known = [*BRONZE, *VIEWS]
    order: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(_view_text(name))
                if name not in order:
                    order.append(name)

    visit(select)
    if not order:
        return select
    ctes = ",\n".join(f"{n} AS (\n{_view_text(n).strip()}\n)" for n in order)
    body = select.strip()
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    return f"WITH RECURSIVE {ctes}{joiner}{body[5:] if joiner[0] == ',' else body}"


def query(name: str, oracle: str | None = None):
    """Register ``fn(lake)`` under a name, with the SQL that must give the same rows."""
    def add(fn: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Lake(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn
    return add
