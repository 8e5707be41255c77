"""Bronze table contracts (fixed values: the source tables' columns in their
declared order).

The source's small integer types are all 38-digit numbers, so every integer
is ``bigint``; epoch instants are ``bigint`` seconds; ratings are
``decimal(5,2)``; id lists are ``array<bigint>``. Text columns declared with a
255-character limit are checked by the quarantine rule of
:func:`strata.sources.snapshot.flag_bad_rows`.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D = T.LongType(), T.StringType(), T.DoubleType()
R = T.DecimalType(5, 2)
A = T.ArrayType(T.LongType())


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Column order of the games table as declared by the source.
RAW_GAMES = _struct([
    ("id", L), ("name", S), ("first_release_date", L), ("updated_at", L), ("game_modes", A),
    ("game_type", L), ("genres", A), ("platforms", A), ("total_rating", R), ("total_rating_count", L),
    ("franchises", A), ("hypes", L), ("created_at", L), ("slug", S), ("summary", S), ("storyline", S),
    ("checksum", S), ("game_status", L), ("url", S), ("parent_game", L), ("cover", L), ("rating", R),
    ("rating_count", L), ("themes", A), ("player_perspectives", A), ("collections", A), ("keywords", A),
    ("tags", A), ("involved_companies", A), ("similar_games", A), ("external_games", A),
    ("release_dates", A), ("screenshots", A), ("artworks", A), ("videos", A), ("websites", A),
    ("age_ratings", A), ("alternative_names", A), ("game_localizations", A), ("language_supports", A),
    ("game_engines", A), ("aggregated_rating", R), ("aggregated_rating_count", L), ("franchise", L),
    ("version_parent", L), ("version_title", S), ("multiplayer_modes", A), ("ports", A), ("remakes", A),
    ("remasters", A), ("expanded_games", A), ("expansions", A), ("standalone_expansions", A),
    ("bundles", A), ("dlcs", A), ("forks", A),
])

_LOOKUP = [("id", L), ("name", S), ("created_at", L), ("slug", S), ("updated_at", L), ("url", S),
           ("checksum", S)]

RAW_GAMEMODE = _struct(_LOOKUP)
RAW_GENRE = _struct(_LOOKUP)
RAW_PLATFORM = _struct(_LOOKUP + [
    ("alternative_name", S), ("generation", L), ("platform_logo", L), ("versions", A),
    ("platform_type", L), ("platform_family", L), ("abbreviation", S), ("summary", S)])
RAW_FRANCHISE = _struct(_LOOKUP + [("games", A)])
RAW_GAMETYPE = _struct([("id", L), ("type", S), ("created_at", L), ("updated_at", L), ("checksum", S)])
RAW_GAMESTATUS = _struct([("id", L), ("status", S), ("created_at", L), ("updated_at", L), ("checksum", S)])
RAW_POPTYPE = _struct([("id", L), ("popularity_source", L), ("name", S), ("created_at", L), ("updated_at", L),
                       ("checksum", S), ("external_popularity_source", L)])
RAW_POPPRIMITIVE = _struct([("id", L), ("game_id", L), ("popularity_type", L), ("popularity_source", L),
                            ("value", D), ("name", S), ("calculated_at", L), ("created_at", L),
                            ("updated_at", L), ("checksum", S), ("external_popularity_source", L)])

# Landed entity (endpoint) -> bronze table contract.
BRONZE_CONTRACTS = {
    "raw_games": RAW_GAMES,
    "raw_gamemode": RAW_GAMEMODE,
    "raw_genre": RAW_GENRE,
    "raw_platform": RAW_PLATFORM,
    "raw_franchise": RAW_FRANCHISE,
    "raw_gametype": RAW_GAMETYPE,
    "raw_gamestatus": RAW_GAMESTATUS,
    "raw_poptype": RAW_POPTYPE,
    "raw_popprimitive": RAW_POPPRIMITIVE,
}

# Text columns without the 255-character limit (declared TEXT, not VARCHAR(255)).
UNBOUNDED_TEXT = {"summary", "storyline"}
