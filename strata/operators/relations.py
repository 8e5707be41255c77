"""Filters over a declared relationship graph.

Tables are related many-to-one. A filter on the "one" side always restricts
the "many" side; it travels back only over a relationship that is declared to
filter both ways. Given the graph and filters on any tables, :meth:`reduce`
gives every table's surviving rows by semi joins alone, so no table's rows
are ever multiplied, and no call names a path: the graph has it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from strata.operators.semantic import SemanticModel
from strata.session import broadcast_if_small


@dataclass(frozen=True)
class Relationship:
    """Rows of ``many`` point to at most one row of ``one``. ``both``: a filter
    on the many side restricts the one side, too."""

    many: str
    many_key: str
    one: str
    one_key: str
    both: bool = False

    def far(self, table: str) -> str:
        return self.one if table == self.many else self.many

    def key(self, table: str) -> str:
        return self.many_key if table == self.many else self.one_key

    def filters(self, source: str) -> bool:
        """Does a filter on ``source`` reach the other end?"""
        return source == self.one or self.both


@dataclass
class RelationshipGraph:
    """Tables (frames, or functions that build one on first use, so tables off
    every path cost nothing) and their relationships, which must form a
    forest: with two paths between tables a filter would be ambiguous."""

    tables: dict[str, DataFrame | Callable[[], DataFrame]]
    relationships: list[Relationship] = field(default_factory=list)

    def __post_init__(self) -> None:
        parent = {t: t for t in self.tables}

        def top(t: str) -> str:
            while parent[t] != t:
                t = parent[t]
            return t

        for r in self.relationships:
            for end in (r.many, r.one):
                if end not in self.tables:
                    raise ValueError(f"relationship with unknown table {end!r}")
            a, b = top(r.many), top(r.one)
            if a == b:
                raise ValueError(f"a second path between {r.many!r} and {r.one!r}")
            parent[a] = b

    def frame(self, name: str) -> DataFrame:
        table = self.tables[name]
        if callable(table):
            table = self.tables[name] = table()
        return table

    def reaches(self, source: str, target: str) -> bool:
        """Does a filter on ``source`` restrict ``target``?"""
        return source == target or target in self._reached(source)

    def _reached(self, source: str) -> set[str]:
        seen, todo = {source}, [source]
        while todo:
            at = todo.pop()
            for r in self.relationships:
                if at in (r.many, r.one) and r.filters(at) and r.far(at) not in seen:
                    seen.add(r.far(at))
                    todo.append(r.far(at))
        return seen - {source}

    def reduce(self, filters: Mapping[str, Column], targets: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """The rows of every table in ``targets`` (all by default) that
        survive ``filters`` (table -> predicate on its own columns).

        The forest is walked towards each target; a branch without a filter,
        or whose filter cannot travel that way, adds no join. Keys are
        deduplicated before each semi join, with a partial aggregate in every
        task, so a key that holds a third of a table is one row in the join;
        they are broadcast only within a size bound. A row whose key is null or
        unknown has no partner and falls to any filter that reaches it over
        that key; without one it stays (the blank member).
        """
        for name in filters:
            if name not in self.tables:
                raise ValueError(f"filter on unknown table {name!r}")
        out = {}
        for target in self.tables if targets is None else targets:
            kept = self._reduced(target, None, filters)
            out[target] = self.frame(target) if kept is None else kept
        return out

    def _reduced(self, name: str, came_by: Relationship | None, filters: Mapping[str, Column]) -> DataFrame | None:
        """``name``'s rows under the filters on its side of ``came_by``; None
        if none reaches it."""
        kept = self.frame(name).filter(filters[name]) if name in filters else None
        for r in self.relationships:
            if r is came_by or name not in (r.many, r.one):
                continue
            far = r.far(name)
            if not r.filters(far):
                continue
            other = self._reduced(far, r, filters)
            if other is None:
                continue
            mine, theirs = r.key(name), r.key(far)
            keys = broadcast_if_small(other.select(other[theirs].alias("__key")).filter("__key is not null").distinct())
            kept = self.frame(name) if kept is None else kept
            kept = kept.join(keys, kept[mine] == keys["__key"], "left_semi")
        return kept


def model_graph(model: SemanticModel, fact_name: str = "fact") -> RelationshipGraph:
    """The relationships of a semantic model: the fact, its dimensions (over
    their bridges, "name bridge", or by the fact's own key) and the related
    facts, which filter both ways, with their dimensions. A dimension without
    a table is its bridge's key column, so filters on it name the bridge."""
    tables: dict[str, DataFrame | Callable[[], DataFrame]] = {fact_name: model.fact}
    links: list[Relationship] = []

    def attach(d, many: str) -> None:
        if d.table is not None:
            tables[d.name] = d.table
            links.append(Relationship(many, d.bridge_dim_key or d.key, d.name, d.key, d.both_directions))

    for d in model.dims.values():
        if d.bridge is None:
            attach(d, fact_name)
            continue
        bridge = f"{d.name} bridge"
        tables[bridge] = d.bridge_frame if callable(d.bridge) else d.bridge
        links.append(Relationship(bridge, d.bridge_fact_key, fact_name, model.fact_key, d.both_directions))
        attach(d, bridge)
    for name, r in model.related.items():
        tables[name] = r.table
        links.append(Relationship(name, r.key, fact_name, model.fact_key, True))
        for d in r.dims.values():
            attach(d, name)
    return RelationshipGraph(tables, links)
