"""python -m panelkit RAW OUT: refresh all tables from RAW/<source>.csv under OUT and check them."""

from __future__ import annotations

import argparse
import sys

from panelkit.plans import warehouse
from panelkit.session import build_session


def main() -> int:
    parser = argparse.ArgumentParser(prog="panelkit", description=__doc__)
    parser.add_argument("raw", help="folder with one CSV file per source: " + ", ".join(warehouse.SOURCES))
    parser.add_argument("out", help="folder for the tables")
    args = parser.parse_args()
    spark = build_session()
    for name, rows in warehouse.load(spark, {n: f"{args.raw}/{n}.csv" for n in warehouse.SOURCES}, args.out).items():
        print(f"{name}: " + ("no file, table kept" if rows is None else f"{rows} rows"))
    tables = warehouse.run(spark, args.out)
    failed = warehouse.check(tables).where("failures > 0").orderBy("check").collect()
    for row in failed:
        print(f"failed {row['check']}: {row['failures']}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
