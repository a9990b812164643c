"""Figures of the store: mix, headline numbers, trend, newest posts, search."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from moodlake.operators import search, sums, trend
from moodlake.session import build_session
from moodlake.sources.store import read_enriched, read_sums


def _show(lines: DataFrame, most: int) -> None:
    """Print at most so many lines, and how many were left out."""
    lines.show(most, truncate=False)
    if left := lines.offset(most).count():
        print(f"{left} more lines not shown (--rows {most})")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("store")
    parser.add_argument("--view", choices=list(trend.VIEWS), default="Month")
    parser.add_argument("--width", default="1 day", help="width of a trend point")
    parser.add_argument("--term", help="sentiment mix of the posts with this term")
    parser.add_argument("--search", help="posts that hold this text")
    parser.add_argument("--as-of", help="end of the hours looked at for --term (default: newest post)")
    parser.add_argument("--hours", type=int, default=1)
    parser.add_argument("--rows", type=int, default=1000, help="lines printed per report")
    args = parser.parse_args(argv)

    spark = build_session("moodlake-report")
    rows, counted = read_enriched(spark, args.store), read_sums(spark, args.store)
    sums.kpi_summary(counted).show(truncate=False)
    _show(sums.mix(counted).orderBy(F.desc("n")), args.rows)
    _show(sums.failure_rate(counted).orderBy(F.desc("n")), args.rows)
    # Sums are by the hour, so other widths need the posts themselves.
    hourly = args.width.split()[-1].rstrip("s") in ("hour", "day", "week")
    points = sums.sentiment_trend(counted, args.width) if hourly else trend.sentiment_trend(rows, args.width)
    trend.last_points(points, args.view).show(28, truncate=False)
    trend.recent_feed(rows).show(truncate=False)
    if args.search:
        _show(search.text_search(rows, args.search), args.rows)
    if args.term:
        as_of = F.lit(args.as_of).cast("timestamp") if args.as_of else rows.agg(F.max("timestamp")).scalar()
        _show(search.term_mix(rows, args.term, as_of, args.hours), args.rows)


if __name__ == "__main__":
    main()
