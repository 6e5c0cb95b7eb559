"""Command line: ``python -m strata <command>``.

    run-all    --sf-dir DIR --out BASE [--grain day|month] [--gate]   full refresh (L1), prints summary and messages
    run-domain DOMAIN --sf-dir DIR --out BASE [--gate]      one domain downstream (L2); --gate fails the run on failed checks
    query      NAME --sf-dir DIR [--rows N] [--explain]      run a registered query, show N rows or its plan
    list                                                     registered query names

Without ``--master`` the master comes from the launcher (``spark-submit
strata/__main__.py ...`` on a cluster) or PySpark's default, ``local[*]``.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strata")
    parser.add_argument("--master", default=None)
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    sub = parser.add_subparsers(dest="cmd", required=True)
    p_all = sub.add_parser("run-all")
    p_all.add_argument("--sf-dir", required=True)
    p_all.add_argument("--out", required=True)
    p_all.add_argument("--grain", default="day", choices=["day", "month"])
    p_all.add_argument("--gate", action="store_true", help="raise when a check of severity error fails")
    p_dom = sub.add_parser("run-domain")
    p_dom.add_argument("domain")
    p_dom.add_argument("--sf-dir", required=True)
    p_dom.add_argument("--out", required=True)
    p_dom.add_argument("--grain", default="day", choices=["day", "month"])
    p_dom.add_argument("--gate", action="store_true", help="raise when a check of severity error fails")
    p_q = sub.add_parser("query")
    p_q.add_argument("name")
    p_q.add_argument("--sf-dir", required=True)
    p_q.add_argument("--rows", type=int, default=20)
    p_q.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of rows")
    sub.add_parser("list")
    args = parser.parse_args(argv)

    if args.cmd == "list":
        from strata.plans.registry import QUERIES
        print("\n".join(sorted(QUERIES)))
        return 0

    from strata.session import build_session, ensure_checkpoint_dir

    spark = build_session(app=f"strata-{args.cmd}", master=args.master, shuffle_partitions=args.shuffle_partitions)
    ensure_checkpoint_dir(spark)
    try:
        if args.cmd == "query":
            from strata.plans.registry import QUERIES
            df = QUERIES[args.name](spark, args.sf_dir)
            if args.explain:
                df.explain("formatted")
            else:
                df.show(args.rows, truncate=False)
            return 0
        from strata.plans import jobs
        if args.cmd == "run-all":
            result = jobs.run_all(spark, args.sf_dir, args.out, grain=args.grain, gate=args.gate)
        else:
            result = jobs.run_domain(spark, args.domain, args.sf_dir, args.out, grain=args.grain, gate=args.gate)
        result.summary.show(truncate=False)
        for title, body in result.messages:
            print(f"## {title}\n{body}\n")
        return 0 if result.summary.first()["overall_status"] == "PASSED" else 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
