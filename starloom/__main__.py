"""Command line: run a named query, or SQL text, over the warehouse of a data folder.

    python -m starloom --list
    python -m starloom q01_monthly [--sf-dir DIR] [--rows N] [--explain]
    python -m starloom --sql "SELECT segment, COUNT(*) AS n FROM fact_rfm GROUP BY segment"

The warehouse is built from the folder's tables once per run (see
``sources/warehouse.py``); results are shown with ``DataFrame.show``.
"""

from __future__ import annotations

import argparse
import sys

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m starloom", description=__doc__.splitlines()[0])
    ap.add_argument("query", nargs="?", help="registered query name")
    ap.add_argument("--sql", help="SQL text over dim_date, dim_customer, dim_product, fact_sales, fact_rfm")
    ap.add_argument("--sf-dir", default=DEFAULT_SF_DIR)
    ap.add_argument("--rows", type=int, default=50, help="rows to show")
    ap.add_argument("--list", action="store_true", help="list the registered queries")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of rows")
    args = ap.parse_args(argv)

    from .plans import registry
    names = registry.queries()
    if args.list:
        print("\n".join(sorted(names)))
        return 0
    if not args.query and not args.sql:
        ap.print_usage()
        return 2
    if args.query and args.query not in names:
        print(f"unknown query {args.query!r}; use --list", file=sys.stderr)
        return 2

    from .session import get_spark
    spark = get_spark()
    if args.sql:
        from .plans.sql import run_sql
        from .sources import warehouse as WH
        df = run_sql(WH.for_testdata(spark, args.sf_dir), args.sql)
    else:
        df = names[args.query](spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
