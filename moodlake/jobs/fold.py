"""Fold the small writes of a store into one and remove what no longer counts; readers and writers may go on meanwhile."""

from __future__ import annotations

import argparse

from moodlake.session import build_session
from moodlake.sources.store import SMALL_ROWS, fold, vacuum


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("store")
    parser.add_argument("--below", type=int, default=SMALL_ROWS, help="fold writes of fewer rows")
    parser.add_argument("--keep-hours", type=float, default=72, help="age of replaced or never committed folders to remove")
    args = parser.parse_args(argv)

    spark = build_session("moodlake-fold")
    version = fold(spark, args.store, args.below)
    print("nothing to fold" if version is None else f"folded in version {version}")
    print(f"{len(vacuum(spark, args.store, args.keep_hours))} folders removed")


if __name__ == "__main__":
    main()
