"""Command line: ``python -m foliant list`` and ``python -m foliant run NAME DATA_DIR OUT_DIR``."""

from __future__ import annotations

import argparse

from foliant import registry
from foliant.session import local_session


def main() -> None:
    p = argparse.ArgumentParser(prog="foliant")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of all queries")
    r = sub.add_parser("run", help="run a query over the tables of a folder and write Parquet")
    r.add_argument("name")
    r.add_argument("data")
    r.add_argument("out")
    a = p.parse_args()
    names = registry.queries()
    if a.command == "list":
        print("\n".join(sorted(names)))
        return
    names[a.name](local_session(), a.data).write.mode("overwrite").parquet(a.out)


if __name__ == "__main__":
    main()
