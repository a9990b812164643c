"""CSV files -> validated messages on the broker (or as JSON lines in a folder)."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation, functions as F

from moodlake.operators.ingest import messages, normalise, observe_counts, tag_rejects
from moodlake.session import build_session, scratch_scope
from moodlake.sources import broker
from moodlake.sources.csv_files import read_csv
from moodlake.streaming import ingest
from moodlake.streaming.enrich import run


def main(argv: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("csv", nargs="+", help="files or folders")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="broker addresses")
    target.add_argument("--out", help="folder for JSON lines instead of a broker")
    parser.add_argument("--topic", default=broker.TOPIC)
    parser.add_argument("--max-records", type=int, help="testing cap on input rows")
    parser.add_argument("--encoding", help="of all files, which then share one header: saves judging them")
    parser.add_argument("--single-line", action="store_true", help="no field holds a newline")
    parser.add_argument("--now", action="store_true", help="unreadable timestamps become the time of the run")
    parser.add_argument("--rejects", help="folder for the rejected rows and their reasons, as JSON lines")
    parser.add_argument("--follow", action="store_true", help="take in new files as a stream; --out then gets messages, rejects and counts")
    parser.add_argument("--checkpoint", help="stream state; needed with --follow")
    parser.add_argument("--trigger", default="10 seconds", help="of the stream")
    parser.add_argument("--once", action="store_true", help="with --follow: work off what is there and stop")
    args = parser.parse_args(argv)
    if args.follow and (not args.checkpoint or not args.out or len(args.csv) > 1 or args.max_records or args.rejects):
        parser.error("--follow needs one folder, --out and --checkpoint, and takes neither --max-records nor --rejects")

    spark = build_session("moodlake-ingest")
    if args.follow:
        now = F.current_timestamp() if args.now else None
        run(ingest.follow(
            spark, args.csv[0], args.out, args.checkpoint, None if args.once else args.trigger,
            encoding=args.encoding or "UTF-8", default_ts=now,
        ))
        sums = ingest.progress(spark, args.out).agg(*[F.sum(c).alias(c) for c in ("read", "accepted", "rejected")]).first().asDict()
        print(sums)
        return sums
    rows = read_csv(
        spark, args.csv, multi_line=not args.single_line, max_records=args.max_records,
        encoding=args.encoding,
    )
    counts = Observation("ingest")
    with scratch_scope(spark):
        if args.rejects:
            # Staged once: the files are not read again for the rejects.
            valid, rejects = ingest.split_staged(rows, counts)
            rejects.write.json(args.rejects)
        else:
            valid = observe_counts(tag_rejects(rows), counts).filter("reject_reason IS NULL")
        out = messages(normalise(valid, F.current_timestamp() if args.now else None))
        if args.servers:
            broker.write_batch(out, args.servers, args.topic)
        else:
            out.write.text(args.out)
    print(counts.get)
    return counts.get


if __name__ == "__main__":
    main()
