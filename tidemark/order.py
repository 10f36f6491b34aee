"""Which table comes after which: references between tables, and what star tables are built from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from graphlib import TopologicalSorter

from .schemas import CLEAN, STAR, Constraints

BUILT_FROM = {
    "dim_date": ("subscriptions",),
    "dim_account": ("accounts",),
    "dim_subscription": ("subscriptions", "dim_account"),
    "fact_subscriptions": ("subscriptions",),
    "fact_churn_events": ("churn_events",),
    "fact_subscription_usage": ("feature_usage", "support_tickets"),
}


def dependencies(tables: Mapping[str, Constraints] = CLEAN | STAR, built_from: Mapping[str, tuple] = BUILT_FROM) -> dict[str, set[str]]:
    """For each table those it refers to or is built from."""
    return {t: {r.parent for r in c.references} | set(built_from.get(t, ())) for t, c in tables.items()}


def load_order(graph: Mapping[str, set[str]] | None = None) -> list[str]:
    """Every table after those it needs; a circle of references raises ``graphlib.CycleError``."""
    return list(TopologicalSorter(graph or dependencies()).static_order())


def reset_order(graph: Mapping[str, set[str]] | None = None) -> list[str]:
    """Every table before those it needs."""
    return load_order(graph)[::-1]


def dependents(changed: Iterable[str], graph: Mapping[str, set[str]] | None = None) -> list[str]:
    """The changed tables and all that need one of them, in load order."""
    graph, out = graph or dependencies(), set(changed)
    order = load_order(graph)
    for table in order:
        if graph[table] & out:
            out.add(table)
    return [t for t in order if t in out]


def levels(graph: Mapping[str, set[str]] | None = None) -> dict[str, int]:
    """How many tables stand one behind the other before each; those of one level can load at the same time."""
    graph = graph or dependencies()
    depth: dict[str, int] = {}
    for table in load_order(graph):
        depth[table] = 1 + max((depth[t] for t in graph[table]), default=-1)
    return depth
