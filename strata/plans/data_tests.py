"""The silver models' column tests (D1-D5): 66 checks over 13 models.

Fixed values: which model columns are tested how, and the accepted status
labels. Lookup models share one pattern (id unique, not NULL, >= 0; label
unique and not NULL; created date not NULL), so it is written once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from strata.operators.quality import Check, run_checks

ACCEPTED_STATUSES = ["Alpha", "Beta", "Cancelled", "Delisted", "Early Access", "Offline", "Released", "Rumored"]


def _id_checks() -> list[Check]:
    return [Check("unique", "id"), Check("not_null", "id"),
            Check("accepted_range", "id", {"min_value": 0, "inclusive": True})]


def _lookup_checks(label: str) -> list[Check]:
    return _id_checks() + [Check("unique", label), Check("not_null", label), Check("not_null", "date_created_at")]


def _non_negative(col: str) -> Check:
    return Check("accepted_range", col, {"min_value": 0, "inclusive": True})


SILVER_CHECKS: dict[str, list[Check]] = {
    "clean_games": _id_checks() + [
        Check("not_null", "name"),
        Check("accepted_range", "average_rating", {"min_value": 0, "max_value": 100, "inclusive": True}),
        Check("not_null", "num_of_reviews"), _non_negative("num_of_reviews"),
        Check("not_null", "wishlist_count"), _non_negative("wishlist_count"),
    ],
    "clean_franchise": _lookup_checks("name"),
    "clean_gamemode": _lookup_checks("name"),
    "clean_gametype": _lookup_checks("type"),
    "clean_genre": _lookup_checks("name"),
    "clean_platform": _lookup_checks("name"),
    "clean_poptype": _id_checks() + [Check("unique", "name"), Check("not_null", "name")],
    "clean_popprimitive": _id_checks() + [
        Check("unique", "fk_game"), Check("not_null", "fk_game"), Check("not_null", "fk_popularity_type"),
        Check("not_null", "popularity_score"), Check("not_null", "date_measured_at"),
    ],
    "clean_gamestatus": _id_checks() + [
        Check("unique", "status"), Check("not_null", "status"),
        Check("accepted_values", "status", {"values": ACCEPTED_STATUSES}),
    ],
    "clean_bridge_franchise": [Check("not_null", "fk_game"), Check("not_null", "fk_franchise")],
    "clean_bridge_gamemode": [Check("not_null", "fk_game"), Check("not_null", "fk_game_mode")],
    "clean_bridge_genre": [Check("not_null", "fk_game"), Check("not_null", "fk_genre")],
    "clean_bridge_platform": [Check("not_null", "fk_game"), Check("not_null", "fk_platform")],
}


def run_silver_checks(silver: Mapping[str, DataFrame]) -> DataFrame:
    """(table, pos, check, failures) for every check of every present model:
    one aggregation pass per model plus one group-by per unique check."""
    results = [run_checks(silver[m], checks, m) for m, checks in SILVER_CHECKS.items() if m in silver]
    if not results:
        raise ValueError("no silver model to test")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
