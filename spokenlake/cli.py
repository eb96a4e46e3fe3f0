"""python -m spokenlake.cli NAME FOLDER: runs a registered query; prints JSON lines or writes a table. Exit code 1 on any failure."""

from __future__ import annotations

import argparse
import sys


def positive_int(value: str) -> int:
    number = int(value)
    if number <= 0:
        raise argparse.ArgumentTypeError(f"{value} is not positive")
    return number


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=__doc__)
    out.add_argument("name")
    out.add_argument("folder")
    where = out.add_mutually_exclusive_group()
    where.add_argument("--rows", type=positive_int, default=20, help="rows printed, in the result's order")
    where.add_argument("--table", help="a folder for the whole result")
    return out


def main(arguments: list[str] | None = None) -> int:
    given = parser().parse_args(arguments)
    from spokenlake.plans import registry
    from spokenlake.session import build_session
    from spokenlake.sinks import console, write_json

    try:
        found = registry.QUERIES[given.name](build_session(), given.folder)
        if given.table:
            write_json(found, given.table)
        else:
            print(console(found.limit(given.rows)))
    except Exception as e:  # noqa: BLE001 - a command reports any failure and ends
        print(f"{given.name}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
