"""Star-schema semantics with many-to-many bridges.

The BI model's behaviour, re-expressed as joins:

* a filter on any dimension restricts the fact through its bridge and, from
  there, every table related "both ways" -- a chain of ``left_semi`` joins on
  the fact key (never inner joins, which would multiply fact rows);
* grouping a fact by a bridged dimension's *label* counts each fact row once
  per label, however many bridge rows (or same-named dimension members) link
  them -- a ``distinct`` on (label, fact key) before the fact is joined;
* bridge keys with no dimension member form one NULL-label ("blank") group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import collated, group_by_name
from strata.session import broadcast_if_small


@dataclass
class Dimension:
    """A dimension reachable from the fact.

    ``bridge`` holds (fact key, dimension key) pairs for a many-to-many
    dimension -- a frame, or a function building one on first use so unused
    bridges cost nothing; for a many-to-one attribute leave it ``None`` and the
    key is read from the fact itself.
    """

    name: str
    table: DataFrame | None
    key: str
    label: str | None = None
    bridge: DataFrame | Callable[[], DataFrame] | None = None
    bridge_fact_key: str | None = None
    bridge_dim_key: str | None = None
    include_blank: bool = True
    both_directions: bool = True  # False: the dimension filters the fact, not the reverse

    def bridge_frame(self) -> DataFrame | None:
        if callable(self.bridge):
            self.bridge = self.bridge()
        return self.bridge


@dataclass
class RelatedFact:
    """A second fact on the many side of the first, related both ways over
    ``key``, with many-to-one dimensions of its own."""

    table: DataFrame
    key: str
    dims: dict[str, Dimension] = field(default_factory=dict)


@dataclass
class SemanticModel:
    fact: DataFrame
    fact_key: str
    dims: dict[str, Dimension] = field(default_factory=dict)
    related: dict[str, RelatedFact] = field(default_factory=dict)

    def related_with(self, dim_name: str) -> RelatedFact | None:
        return next((r for r in self.related.values() if dim_name in r.dims), None)


def _member_keys(d: Dimension, labels: Iterable) -> DataFrame:
    return d.table.filter(F.col(d.label).isin(list(labels))).select(F.col(d.key))


def related_rows(model: SemanticModel, name: str, filters: Mapping[str, Iterable] | None = None,
                 facts: DataFrame | None = None) -> DataFrame:
    """Rows of a related fact under a filter context: its own dimensions'
    selections, and the first fact's surviving rows where ``facts`` is given
    (J6 over the fact-to-fact relationship). All are semi joins."""
    r = model.related[name]
    out = r.table
    for dim_name, labels in (filters or {}).items():
        if dim_name in r.dims and labels:
            d = r.dims[dim_name]
            out = out.join(_member_keys(d, labels), d.key, "left_semi")
    if facts is not None:
        out = out.join(facts.select(F.col(model.fact_key).alias(r.key)), r.key, "left_semi")
    return out


def related_labels(model: SemanticModel, name: str, dim_name: str, facts: DataFrame | None = None) -> DataFrame:
    """Labels of a related fact's dimension that its rows carry in a context
    (A16); keys without a member give the blank label. (fact, key) pairs are
    deduplicated before any join."""
    r = model.related[name]
    d = r.dims[dim_name]
    pairs = r.table.select(r.key, d.key).distinct()
    if facts is not None:
        pairs = pairs.join(facts.select(F.col(model.fact_key).alias(r.key)), r.key, "left_semi")
    keys = pairs.select(d.key).distinct()
    return keys.join(d.table.select(d.key, d.label), d.key, "left").select(F.col(d.label).alias("label")).distinct()


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           columns: Iterable[str]) -> DataFrame:
    """Many-to-one lookup (J1/J4): attach ``columns`` of ``dim`` to every fact
    row; keys without a match keep NULLs (the blank member)."""
    right = dim.select(F.col(dim_key).alias("_dk"), *columns)
    right = broadcast_if_small(right)
    out = fact.join(right, fact[fact_key] == right["_dk"], "left")
    return out.drop("_dk")


def label_pairs(model: SemanticModel, dim_name: str) -> DataFrame:
    """Distinct (label, fact key) pairs of one dimension (J5). (fact, dim key)
    pairs are deduplicated before the join, with a partial aggregate in every
    task, so a hot key can't inflate it whatever strategy is picked."""
    d = model.dims[dim_name]
    fk = model.fact_key
    bridge = d.bridge_frame()
    if bridge is None:
        pairs = model.fact.select(F.col(fk), F.col(d.key).alias("_dk"))
    else:
        pairs = bridge.select(F.col(d.bridge_fact_key).alias(fk), F.col(d.bridge_dim_key).alias("_dk"))
    if d.table is None:  # the key is its own label
        return pairs.select(F.col("_dk").alias("label"), fk).distinct()
    dim = d.table.select(F.col(d.key).alias("_dk"), F.col(d.label).alias("label"))
    joined = pairs.distinct().join(broadcast_if_small(dim), "_dk", "left" if d.include_blank else "inner")
    return joined.select("label", fk).distinct()


def fact_keys_with_labels(model: SemanticModel, dim_name: str, labels: Iterable) -> DataFrame:
    """Fact keys linked to any of ``labels`` of one dimension (P5 on a
    dimension, as a set of fact keys). Bridge pairs are deduplicated before
    the semi join, with a partial aggregate in every task, so neither a fact
    row nor a dimension key that holds a large share of the bridge sends all
    of its rows to one task."""
    d = model.dims[dim_name]
    fk = model.fact_key
    labels = list(labels)
    if d.table is None:
        keys = None
    else:
        keys = d.table.filter(F.col(d.label).isin(labels)).select(F.col(d.key).alias("_dk"))
    bridge = d.bridge_frame()
    if bridge is None:
        if keys is None:
            return model.fact.filter(F.col(d.key).isin(labels)).select(fk)
        return model.fact.join(keys, model.fact[d.key] == keys["_dk"], "left_semi").select(fk)
    b = bridge.select(F.col(d.bridge_fact_key).alias(fk), F.col(d.bridge_dim_key).alias("_dk"))
    if keys is None:
        return b.filter(F.col("_dk").isin(labels)).select(fk).distinct()
    # pairs first: a dimension key that holds a third of the bridge's rows has
    # at most one row per fact key in the join
    return b.distinct().join(broadcast_if_small(keys), "_dk", "left_semi").select(fk).distinct()


def propagate(model: SemanticModel, filters: Mapping[str, Iterable] | None = None,
              fact_filter: Column | None = None) -> DataFrame:
    """The fact rows that survive a filter context.

    ``filters`` maps dimension name -> selected labels (``None``/empty means
    "all"); ``fact_filter`` is a predicate on the fact's own columns (e.g. a
    status slicer). Each dimension filter is one semi join on the fact key.
    """
    out = model.fact if fact_filter is None else model.fact.filter(fact_filter)
    for name, labels in (filters or {}).items():
        if labels is None:
            continue
        labels = list(labels)
        if not labels:
            continue
        r = model.related_with(name)
        if r is not None and name not in model.dims:  # the other fact restricts this one
            keys = related_rows(model, next(k for k, v in model.related.items() if v is r), {name: labels})
            out = out.join(keys.select(F.col(r.key).alias(model.fact_key)).distinct(), model.fact_key, "left_semi")
            continue
        out = out.join(fact_keys_with_labels(model, name, labels), model.fact_key, "left_semi")
    return out


def metric_by_label(model: SemanticModel, dim_name: str, aggs: Mapping[str, Column],
                    facts: DataFrame | None = None, collation: str | None = None) -> DataFrame:
    """Group the (filtered) fact by a dimension's label, each fact row counted
    once per label (A12 over J5). Fact rows without a bridge row fall out.
    Under a collation, labels that it calls equal are one: a fact row with
    several of their spellings still counts once."""
    facts = model.fact if facts is None else facts
    pairs = label_pairs(model, dim_name)
    if collation is not None:
        pairs = pairs.groupBy(collated("label", collation).alias("_same"), model.fact_key).agg(F.min("label").alias("label")).drop("_same")
    return group_by_name(pairs.join(facts, model.fact_key, "inner"), "label", aggs, collation)


def label_values(model: SemanticModel, dim_name: str, facts: DataFrame | None = None) -> DataFrame:
    """The labels a slicer offers under the filters that reach it.
    A one-way dimension is not filtered by the fact, so it offers all its
    labels."""
    d = model.dims[dim_name]
    if not d.both_directions and d.table is not None:
        return d.table.select(F.col(d.label).alias("label")).distinct()
    facts = model.fact if facts is None else facts
    pairs = label_pairs(model, dim_name)
    return pairs.join(facts.select(model.fact_key), model.fact_key, "left_semi").select("label").distinct()
