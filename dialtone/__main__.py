"""Run registered queries from the command line.

    python -m dialtone list
    python -m dialtone run summary_max --sf /root/testdata/sf0.01 [--show 20 | --out PATH]
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="dialtone")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    r = sub.add_parser("run", help="run one registered query")
    r.add_argument("name")
    r.add_argument("--sf", default="/root/testdata/sf0.01", help="folder with the parquet tables")
    r.add_argument("--show", type=int, default=20, help="rows to print (when --out is not set)")
    r.add_argument("--out", help="write the full result as parquet here instead of printing")
    r.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    a = p.parse_args(argv)

    from .plans.queries import ALL_QUERIES
    if a.cmd == "list":
        for name in ALL_QUERIES:
            print(name)
        return
    from .session import build_session
    spark = build_session()
    df = ALL_QUERIES[a.name](spark, a.sf)
    if a.explain:
        df.explain("formatted")
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
        print(a.out)
    else:
        df.show(a.show, truncate=False)


if __name__ == "__main__":
    main()
