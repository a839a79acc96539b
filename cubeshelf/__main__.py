"""Command line: `python -m cubeshelf <command> ...`

    refresh  whole refresh: plan, archives, convert, publish, catalog, tables;
             --until ends after a step, --resume goes on with a run
    discover listing -> fresh catalog parquet
    plan     only the plan: which datasets are new or due (nothing is written
             to the warehouse; --out writes the work list)
    query    run SQL over the warehouse tables, print {"columns", "data"} JSON
    vacuum   remove old catalog snapshots and the staging of ended applications
    watch    plan every listing document that landed since the last call

`LIMIT` in the environment is the default for --limit (new datasets per run).
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def _limit_default():
    v = os.environ.get("LIMIT")
    return int(v) if v else None


def _parser() -> argparse.ArgumentParser:
    from .plans.refresh import STEPS

    p = argparse.ArgumentParser(prog="cubeshelf")
    p.add_argument("--master", default=None, help="Spark master (default: the environment's)")
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("refresh")
    r.add_argument("--landing", help="new run: listing.json and archives/")
    r.add_argument("--root", help="new run: the warehouse")
    r.add_argument("--resume", metavar="RUN", help="take up a run (its folder) at its first unfinished step, with its settings")
    r.add_argument("--until", metavar="STEP", help="end after this step: " + ", ".join(STEPS))
    r.add_argument("--worklist", help="ingest this work list (as `plan --out` writes it) instead of planning")
    r.add_argument("--db", default="warehouse")
    r.add_argument("--as-of", default=None)
    r.add_argument("--limit", type=int, default=_limit_default())
    r.add_argument("--max-total-gb", type=float, default=None, help="default: no cap")
    r.add_argument("--timeout", type=float, default=None, help="seconds per conversion job (default: none)")
    r.add_argument("--skip-invisible-planned", action="store_true")
    r.add_argument("--keep-staging", action="store_true")
    r.add_argument("--allow-empty-listing", action="store_true")
    r.add_argument("--frequency-map", type=json.loads, default={}, help='JSON, listing code -> label or days')
    r.add_argument("--workers", type=int, default=4)
    r.add_argument("--legacy", action="store_true", help="no planning: take what is not landed yet")
    r.add_argument("--strict-parity", action="store_true")
    r.add_argument("--quarantine", action="store_true", help="ragged rows go aside instead of failing")

    d = sub.add_parser("discover")
    d.add_argument("--listing", required=True, help="JSON array document(s)")
    d.add_argument("--out", required=True)

    pl = sub.add_parser("plan")
    pl.add_argument("--landing", required=True)
    pl.add_argument("--root", required=True)
    pl.add_argument("--as-of", default=None)
    pl.add_argument("--limit", type=int, default=_limit_default())
    pl.add_argument("--frequency-map", type=json.loads, default={}, help='JSON, listing code -> label or days')
    pl.add_argument("--show", type=int, default=20, help="work-list rows to print")
    pl.add_argument("--out", default=None, help="write the work list here (parquet)")

    q = sub.add_parser("query")
    q.add_argument("--root", required=True)
    q.add_argument("--db", default="warehouse")
    q.add_argument("--max-rows", type=int, default=1000)
    q.add_argument("--sync", action="store_true", help="register every dataset first (default: those that the SQL names)")
    q.add_argument("--no-sync", action="store_true", help=argparse.SUPPRESS)  # what is the default now
    q.add_argument("sql")

    v = sub.add_parser("vacuum")
    v.add_argument("--root", required=True)
    v.add_argument("--keep", type=int, default=10, help="catalog commits to keep")
    v.add_argument("--grace-hours", type=float, default=168.0, help="nothing younger is removed")

    w = sub.add_parser("watch")
    w.add_argument("--listings", required=True)
    w.add_argument("--root", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--as-of", default=None)
    w.add_argument("--limit", type=int, default=_limit_default())
    w.add_argument("--frequency-map", type=json.loads, default={}, help='JSON, listing code -> label or days')
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    own = spark is None
    if own:
        from pyspark.sql import SparkSession
        from .session import DEFAULT_CONF, drop_staging
        b = SparkSession.builder.appName("cubeshelf")
        if args.master:
            b = b.master(args.master)
        for k, v in DEFAULT_CONF.items():
            b = b.config(k, v)
        spark = b.getOrCreate()

    from .plans import refresh as R
    from .schemas import STORED_CATALOG
    from .sources import catalog_store, listing

    if args.command == "refresh":
        if args.resume is None and (args.landing is None or args.root is None):
            parser.error("refresh: --landing and --root, or --resume")
        cfg = None if args.resume else R.RefreshConfig(
            landing=args.landing, root=args.root, db=args.db, as_of=args.as_of, limit=args.limit,
            max_total_gb=args.max_total_gb, workers=args.workers, legacy=args.legacy, worklist=args.worklist,
            strict_parity=args.strict_parity, quarantine=args.quarantine, timeout_s=args.timeout,
            skip_invisible_planned=args.skip_invisible_planned, keep_staging=args.keep_staging,
            allow_empty_listing=args.allow_empty_listing, frequency_mapping=args.frequency_map)
        try:
            out = R.run_refresh(spark, cfg, resume=args.resume, until=args.until)
            out.pop("report")
        except R.RunStopped as e:
            out = {"run": e.run, "stopped_after": e.step}
        print(json.dumps(out, default=str))
    elif args.command == "discover":
        fresh = listing.read_listing(spark, args.listing)
        fresh.write.mode("overwrite").parquet(args.out)
        print(json.dumps({"datasets": spark.read.parquet(args.out).count(), "out": args.out}))
    elif args.command == "plan":
        fresh = listing.read_listing(spark, f"{args.landing.rstrip('/')}/listing.json")
        stored = catalog_store.read_catalog(spark, f"{args.root.rstrip('/')}/catalog", STORED_CATALOG)
        work, summary = R.plan_run(fresh, stored, R._now(args.as_of), args.limit, args.frequency_map)
        if args.out:
            work.write.mode("overwrite").parquet(args.out)
            work = spark.read.parquet(args.out)
        print(json.dumps(summary.first().asDict()))
        for row in work.orderBy("ordinal").limit(args.show).collect():
            print(json.dumps(row.asDict(), default=str))
    elif args.command == "query":
        from .plans.sql import render, warehouse_sql
        root = args.root.rstrip("/")
        if args.sync:
            v = catalog_store.latest_version(spark, f"{root}/catalog")
            if v is not None:
                R.sync_tables(spark, f"{root}/data", f"{root}/catalog/{v}", args.db)
        print(json.dumps(render(warehouse_sql(spark, args.sql, root, args.db), args.max_rows)))
    elif args.command == "vacuum":
        from .operators import vacuum
        grace = args.grace_hours * 3600
        print(json.dumps({"snapshots": vacuum.vacuum_catalog(spark, args.root, args.keep, grace), "staging": vacuum.vacuum_staging(spark, grace)}))
    elif args.command == "watch":
        from .streaming.listing_watch import watch_listings
        root = args.root.rstrip("/")
        watch_listings(spark, args.listings, f"{root}/catalog", args.out,
                       checkpoint=f"{root}/streams/listing-watch", as_of=args.as_of, limit=args.limit,
                       mapping=args.frequency_map)
        print(json.dumps({"out": args.out}))
    if own:
        drop_staging(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
