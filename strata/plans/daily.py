"""One daily run end to end: landed snapshot -> bronze -> silver -> gold -> tests.

The ordinary call order replaces a model compiler: bronze is loaded with
full refresh, silver models are persisted as Parquet tables (each written
once, so every gold view and test reads the materialized result), gold models
stay lazy views over silver, and the column tests run last.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.operators.quality import assert_checks
from strata.plans import gold as G
from strata.plans import silver as SV
from strata.plans.data_tests import run_silver_checks
from strata.schemas import BRONZE_CONTRACTS, UNBOUNDED_TEXT
from strata.sources import catalog as C
from strata.sources import runs
from strata.sources import snapshot as snap


@dataclass
class RunResult:
    bronze: dict[str, DataFrame] = field(default_factory=dict)
    silver: dict[str, DataFrame] = field(default_factory=dict)
    gold: dict[str, DataFrame] = field(default_factory=dict)
    tests: DataFrame | None = None


# silver models joined on the game key, and the column they are bucketed by
GAME_KEYED = {"clean_games": "id", "clean_bridge_franchise": "fk_game", "clean_bridge_gamemode": "fk_game",
              "clean_bridge_genre": "fk_game", "clean_bridge_platform": "fk_game"}


def run_daily(spark: SparkSession, landing_base: str, run_date: str, warehouse: str,
              contracts: dict | None = None, display_names: bool = True,
              fail_on_test: bool = True, catalog: bool = False,
              game_buckets: int | None = None) -> RunResult:
    """Load ``run_date``'s snapshot of every entity and rebuild all layers.

    Re-running the same day replaces every layer with the same content. Bronze
    and silver versions of the whole run become current by one commit, once
    all of them are written: readers of the warehouse see one day in every
    table, and a run that fails leaves them at the run before. With
    ``catalog=True`` silver goes to catalog tables and gold to persistent
    views over them, with display names; ``game_buckets`` then
    buckets the games and the four bridges by game key, so the fact-to-bridge
    joins of the reports run without a shuffle.
    """
    contracts = contracts or BRONZE_CONTRACTS
    warehouse = warehouse.rstrip("/")
    staged = snap.stage_all(spark, landing_base, run_date, contracts, warehouse, unbounded_text=UNBOUNDED_TEXT)
    bronze = {e: snap.loaded_rows(spark.read.parquet(staged[f"bronze/{e}"])) for e in contracts}
    silver = {}
    models = SV.build_silver(bronze)
    if catalog:
        for name, df in models.items():
            buckets = (game_buckets, [GAME_KEYED[name]]) if game_buckets and name in GAME_KEYED else None
            silver[name] = C.materialize(df, "silver", name, kind="table", bucket_by=buckets)
    else:
        with ThreadPoolExecutor(4) as pool:
            jobs = {name: pool.submit(runs.stage, df, f"{warehouse}/silver/{name}", run_date) for name, df in models.items()}
        staged |= {f"silver/{name}": job.result() for name, job in jobs.items()}
        silver = {name: spark.read.parquet(staged[f"silver/{name}"]) for name in models}
    runs.commit(spark, warehouse, run_date, staged)
    if not catalog:
        silver = {name: C.materialize(df, "silver", name, kind="view") for name, df in silver.items()}
    gold = {name: C.materialize(df, "gold", name, kind="view")
            for name, df in G.build_gold(silver, display=display_names).items()}
    if catalog:  # views that outlive the application, over the silver catalog tables
        for name, select in G.view_sql("silver").items():
            if name in gold:
                C.create_view(spark, "gold", name, select)
    tests = run_silver_checks(silver)
    if fail_on_test:
        assert_checks(tests)
    return RunResult(bronze, silver, gold, tests)


def main(argv: list[str] | None = None) -> int:
    """``spark-submit --py-files strata.zip strata/plans/daily.py --landing L --run-date D --warehouse W``

    Runs one day; exits non-zero when any column test fails.
    """
    import argparse

    from strata.session import get_spark, release_scratch

    ap = argparse.ArgumentParser(description="Load one day's snapshot and rebuild all layers.")
    ap.add_argument("--landing", required=True, help="base folder holding raw/{run_date}/{entity}.parquet")
    ap.add_argument("--run-date", required=True, help="yyyyMMdd")
    ap.add_argument("--warehouse", required=True, help="base folder for bronze/silver tables")
    ap.add_argument("--no-fail-on-test", action="store_true", help="report failing tests without failing")
    ap.add_argument("--catalog", action="store_true", help="write silver as catalog tables")
    ap.add_argument("--game-buckets", type=int, default=None,
                    help="with --catalog: bucket games and bridges by game key into this many buckets")
    args = ap.parse_args(argv)
    spark = get_spark(app=f"strata-daily-{args.run_date}")
    result = run_daily(spark, args.landing, args.run_date, args.warehouse, fail_on_test=False,
                       catalog=args.catalog, game_buckets=args.game_buckets)
    failed = result.tests.filter("failures > 0").collect()  # one row per check: bounded
    release_scratch(spark)
    for r in failed:
        print(f"FAILED {r['table']}.{r['check']}: {r['failures']}")
    return 1 if failed and not args.no_fail_on_test else 0


if __name__ == "__main__":
    raise SystemExit(main())
