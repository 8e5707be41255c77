"""strata: a Spark-native medallion and BI-semantics library.

Dated snapshot ingest with contracts and quarantine, silver/gold models with a
Bayesian weighted rating, declarative data tests, a generated calendar, and
BI semantics (filter propagation through many-to-many bridges, tie-keeping
top-N, dense ranks, a switchable grouping dimension) -- all as DataFrame jobs.

The most used entry points are importable from the package root; they are
resolved on first use so ``import strata`` stays cheap.
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "get_spark": "strata.session",
    "partition_settings": "strata.session",
    "run_daily": "strata.plans.daily",
    "SemanticModel": "strata.operators.semantic",
    "Dimension": "strata.operators.semantic",
    "propagate": "strata.operators.semantic",
    "with_weighted_rating": "strata.operators.rating",
    "top_n_with_ties": "strata.operators.topn",
    "dense_top_n": "strata.operators.topn",
    "dense_rank_all": "strata.operators.topn",
    "flatten_bridge": "strata.operators.flatten",
    "run_checks": "strata.operators.quality",
    "Check": "strata.operators.quality",
    "calendar": "strata.sources.calendar",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'strata' has no attribute {name!r}")
