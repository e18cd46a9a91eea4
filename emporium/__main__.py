"""Command line: the ELT job, the post-load checks, the export and ad-hoc queries.

    python -m emporium elt    --source-dir DIR --warehouse-dir WH [--db marketplace] [--export-dir OUT]
    python -m emporium check  --warehouse-dir WH [--db marketplace]
    python -m emporium export --warehouse-dir WH --out OUT [--db marketplace]
    python -m emporium query  --warehouse-dir WH --sql "SELECT * FROM marketplace.vw_seller_monthly"

On a cluster, run through spark-submit; ``--master`` is only for local runs.
Tables land in ``<warehouse-dir>/<db>.db/<table>``; later commands attach them.
"""

from __future__ import annotations

import argparse
import sys

from .plans.clean import CleanOptions
from .session import as_location, build_session, join_location, recommended_conf


def _session(args):
    extra = {"spark.sql.warehouse.dir": as_location(args.warehouse_dir)}
    if args.input_bytes:
        extra = recommended_conf(args.input_bytes, args.cores) | extra
    return build_session(args.master, "emporium", args.shuffle_partitions, extra)


def _attach(spark, args):
    from .sources.warehouse import attach_warehouse
    attach_warehouse(spark, args.db, join_location(as_location(args.warehouse_dir), f"{args.db}.db"))


def cmd_elt(spark, args) -> int:
    from .plans.elt import run_elt
    opts = CleanOptions(enforce_chronology=args.enforce_chronology, impute=args.impute,
                        legacy_nan=args.legacy_nan, legacy_zip=args.legacy_zip)
    res = run_elt(spark, source_dir=args.source_dir, db=args.db, export_dir=args.export_dir, opts=opts,
                  strict=args.strict, buckets=args.buckets, landing_dir=args.landing_dir,
                  multiline="blocks" if args.blocks else not args.single_line, force=args.force)
    if res.pre_load is not None:
        res.pre_load.orderBy("table_name", "check_name", "column_name").show(100, truncate=False)
    res.post_load.orderBy("table_name", "check_name", "column_name").show(100, truncate=False)
    failed = res.post_load.where("status = 'fail'").count()
    print(f"loaded {len(res.tables)} tables into {args.db}; {failed} post-load checks failed")
    return 0


def cmd_check(spark, args) -> int:
    from .operators import quality as Q
    from .sources import warehouse as WH
    _attach(spark, args)
    rep = Q.gate_report(WH.warehouse_tables(spark, args.db), "post_load")
    Q.duplicate_examples(Q.pk_duplicates(WH.warehouse_tables(spark, args.db))).show(truncate=False)
    Q.row_counts(WH.warehouse_tables(spark, args.db)).orderBy("table_name").show(truncate=False)
    rep.orderBy("table_name", "check_name", "column_name").show(100, truncate=False)
    for t, col, dim in [("fact_order_items", "order_id", "dim_orders"),
                        ("fact_order_items", "product_id", "dim_products"),
                        ("fact_order_items", "seller_id", "dim_sellers")]:
        Q.orphan_sample(spark.table(f"{args.db}.{t}"), spark.table(f"{args.db}.{dim}"), col).show()
    return 1 if (args.strict and rep.where("status = 'fail'").count()) else 0


def cmd_export(spark, args) -> int:
    from .sources import warehouse as WH
    _attach(spark, args)
    WH.export_csv(spark, args.db, as_location(args.out), upper=args.upper).show(truncate=False)
    return 0


def cmd_query(spark, args) -> int:
    _attach(spark, args)
    spark.sql(args.sql).show(args.rows, truncate=False)
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="python -m emporium")
    p.add_argument("--master", help="only for local runs; spark-submit decides otherwise")
    p.add_argument("--shuffle-partitions", type=int)
    p.add_argument("--input-bytes", type=int, help="size the session for so much compressed input")
    p.add_argument("--cores", type=int, default=8, help="with --input-bytes: cores of all executors")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--warehouse-dir", required=True)
        sp.add_argument("--db", default="marketplace")

    e = sub.add_parser("elt", help="extract, clean, check, load, create views, export")
    common(e)
    e.add_argument("--source-dir", required=True)
    e.add_argument("--export-dir")
    e.add_argument("--landing-dir")
    e.add_argument("--single-line", action="store_true", help="no quoted newlines: files are read by many tasks")
    e.add_argument("--blocks", action="store_true", help="quoted newlines, and files are read by many tasks")
    e.add_argument("--force", action="store_true", help="load tables anew whose sources did not change")
    e.add_argument("--buckets", type=int)
    e.add_argument("--strict", action="store_true")
    e.add_argument("--enforce-chronology", action="store_true")
    e.add_argument("--impute", choices=["median"])
    e.add_argument("--legacy-nan", action="store_true")
    e.add_argument("--legacy-zip", action="store_true")
    c = sub.add_parser("check", help="post-load checks of a written warehouse")
    common(c)
    c.add_argument("--strict", action="store_true")
    x = sub.add_parser("export", help="every table and view to CSV folders")
    common(x)
    x.add_argument("--out", required=True)
    x.add_argument("--upper", action="store_true", help="column names in upper case")
    q = sub.add_parser("query", help="run SQL over the warehouse tables and views")
    common(q)
    q.add_argument("--sql", required=True)
    q.add_argument("--rows", type=int, default=50)
    args = p.parse_args(argv)
    spark = _session(args)
    try:
        return {"elt": cmd_elt, "check": cmd_check, "export": cmd_export, "query": cmd_query}[args.cmd](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
