"""Command line: list or run the named queries.

    python -m tidemark list
    python -m tidemark run <query> [--sf DIR] [--out PATH] [--show N]

``run`` executes the query on the tables under ``--sf`` and writes the result
as parquet to ``--out`` (or shows the first rows).
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("query")
    run.add_argument("--sf", default="/root/testdata/sf0.01")
    run.add_argument("--out")
    run.add_argument("--show", type=int, default=20)
    args = ap.parse_args(argv)

    from tidemark.plans import catalog
    if args.cmd == "list":
        for name in sorted(catalog.QUERIES):
            print(name, "(sql oracle)" if name in catalog.ORACLE else "")
        return 0
    if args.query not in catalog.QUERIES:
        print(f"unknown query {args.query!r}; see `python -m tidemark list`", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession
    from tidemark.session import checkpoint_dir, get_spark
    active = SparkSession.getActiveSession()
    spark = active or get_spark()
    checkpoint_dir(spark)
    df = catalog.QUERIES[args.query](spark, args.sf)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
