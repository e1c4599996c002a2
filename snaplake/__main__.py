"""Command line for the two scheduled runs and for reading results.

    python -m snaplake daily    --landing DIR --root DIR --date YYYY-MM-DD
    python -m snaplake backfill --landing DIR --root DIR --date YYYY-MM-DD [--from 2000 --to Y]
    python -m snaplake models   --root DIR
    python -m snaplake card     --root DIR --name avg_rating_by_genre
    python -m snaplake show     --root DIR --table gold/agg_historical_analysis [--rows 20]
    python -m snaplake compact  --root DIR --table raw/discover --date YYYY-MM-DD

``--master`` defaults to whatever ``spark-submit`` or the environment provides.
"""

from __future__ import annotations

import argparse
import datetime as dt

from snaplake.plans import cards, gold, jobs, quality
from snaplake.session import get_session
from snaplake.sinks import catalog

def _tested(run) -> None:
    """Show the run's test results; failing ones end the command with an error status."""
    try:
        run()["dq_results"].show(100, truncate=False)
    except quality.DataTestsFailed as e:
        e.results.show(100, truncate=False)
        raise SystemExit(str(e)) from e


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="snaplake")
    ap.add_argument("command", choices=["daily", "backfill", "models", "show", "card", "compact"])
    ap.add_argument("--master")
    ap.add_argument("--landing")
    ap.add_argument("--root", required=True)
    ap.add_argument("--date", default=dt.date.today().isoformat())
    ap.add_argument("--from", dest="year_from", type=int, default=2000)
    ap.add_argument("--to", dest="year_to", type=int)
    ap.add_argument("--table")
    ap.add_argument("--name", choices=sorted(cards.CARDS))
    ap.add_argument("--rows", type=int, default=20)
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    if a.command == "daily":
        _tested(lambda: jobs.run_daily(spark, a.landing, a.root, a.date))
    elif a.command == "backfill":
        to = a.year_to or int(a.date[:4])
        _tested(lambda: jobs.run_backfill(spark, a.landing, a.root,
                                          range(a.year_from, to + 1), a.date))
    elif a.command == "models":
        _tested(lambda: jobs.build_models(spark, a.root))
    elif a.command == "show":
        df = spark.read.parquet(f"{a.root.rstrip('/')}/{a.table}")
        name = a.table.rsplit("/", 1)[-1]
        (gold.ordered(df, name) if name in gold.ORDER else df).show(a.rows, truncate=False)
    elif a.command == "compact":
        from snaplake.sinks.lake import compact
        path = f"{a.root.rstrip('/')}/{a.table}"
        schema = spark.read.parquet(path).schema
        n = compact(spark, path, dt.date.fromisoformat(a.date), schema)
        print(f"{a.table} snapshot_date={a.date}: {n} file(s)")
    elif a.command == "card":
        # The root's table is looked up by name, as a dashboard does.
        name, path = cards.CARDS[a.name][0], f"{a.root.rstrip('/')}/gold/{cards.CARDS[a.name][0]}"
        catalog.create_layers(spark, a.root, ("gold",))
        catalog.register(spark, "gold", name, spark.read.parquet(path).schema, path)
        cards.by_name(spark, a.name).show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
