"""Command line for spark-submit jobs: ``python -m reelhouse build|load ...``.

  build  raw files -> silver and gold tables (catalog namespaces, or parquet under --root)
  load   tables from a parquet folder into targets with a load mode and a report

Only argument handling lives here; the work is ``plans.build.build_all`` and
``operators.loads.load_tables``.
"""

from __future__ import annotations

import argparse
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reelhouse")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build", help="build the silver and gold tables")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-csv", help="folder with movies.csv, ratings.csv, tags.csv, links.csv")
    src.add_argument("--raw-parquet", help="folder with movies/, ratings/, tags/, links/ parquet")
    b.add_argument("--root", help="write parquet folders here instead of catalog tables")
    b.add_argument("--silver-ns", default="silver")
    b.add_argument("--gold-ns", default="gold")
    b.add_argument("--distinct", choices=["exact", "approx"], default="exact",
                   help="approx: HyperLogLog++ for per-month / per-genre distinct counts")
    b.add_argument("--buckets", type=int, help="bucket silver tables by movie_id (catalog tables only)")

    ld = sub.add_parser("load", help="load tables with replace / append / incremental / merge")
    ld.add_argument("--source", required=True, help="folder holding one parquet folder per table")
    ld.add_argument("--tables", nargs="+", required=True)
    ld.add_argument("--target-root", required=True, help="folder of the target tables")
    ld.add_argument("--mode", choices=["replace", "append", "incremental", "merge"], default="append")
    ld.add_argument("--keys", help="comma-separated primary key columns (merge)")
    ld.add_argument("--cursor", help="cursor column (incremental, or merge with a mark)")
    ld.add_argument("--state", help="state table folder for the marks")
    ld.add_argument("--key-buckets", type=int, default=64, help="folders of a keyed (merge) target")
    ld.add_argument("--schema-policy", default="fail",
                    choices=["fail", "ignore", "append_new_columns", "sync_all_columns"])
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from .session import build_session

    spark = build_session(master=None)
    if args.cmd == "build":
        from .plans.build import build_all
        from .sources.readers import read_raw_csvs

        if args.raw_csv:
            raw = read_raw_csvs(spark, args.raw_csv)
        else:
            raw = {n: spark.read.parquet(f"{args.raw_parquet.rstrip('/')}/{n}")
                   for n in ("movies", "ratings", "tags", "links")}
        out = build_all(spark, raw, root=args.root, silver_ns=args.silver_ns, gold_ns=args.gold_ns,
                        distinct=args.distinct, buckets=args.buckets)
        for name, target in out.items():
            print(name, getattr(target, "location", target))
        return 0

    from .operators.loads import KeyedTarget, Target, load_tables

    sources = {t: spark.read.parquet(f"{args.source.rstrip('/')}/{t}") for t in args.tables}
    keys = {t: args.keys.split(",") for t in args.tables} if args.keys else None
    root = args.target_root.rstrip("/")
    merge_schema = args.schema_policy == "append_new_columns"
    targets = {t: KeyedTarget(f"{root}/{t}", tuple(keys[t]), args.key_buckets) if args.mode == "merge" and keys
               else Target(f"{root}/{t}", is_path=True, merge_schema=merge_schema) for t in args.tables}
    state = Target(args.state, is_path=True) if args.state else None
    report = load_tables(spark, sources, targets, mode=args.mode, keys=keys, cursor=args.cursor, state=state,
                         policy=args.schema_policy)
    rows = report.collect()          # one row per table
    for r in rows:
        print(r.table, r.status, r.rows if r.rows is not None else "", r.message or "")
    return 0 if all(r.status == "completed" for r in rows) else 1


if __name__ == "__main__":
    sys.exit(main())
