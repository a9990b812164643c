"""Broker (or folder of JSON lines) -> cleaned and scored posts in the store."""

from __future__ import annotations

import argparse
import importlib

from moodlake.operators.classifier import load, score_with_model
from moodlake.operators.scoring import RetryPolicy, score, score_distinct, score_keywords
from moodlake.session import build_session, scratch_scope
from moodlake.sources import broker
from moodlake.sources.store import write_enriched
from moodlake.streaming import enrich


def _scoring(args: argparse.Namespace):
    if args.model:
        model = load(args.model)
        return lambda df: score_with_model(model, df)
    if not args.scorer:
        return score_keywords
    retry = RetryPolicy(attempts=args.attempts, rest_after=args.rest_after, rest_seconds=args.rest_seconds)
    settings = {"retry": retry, "call_size": args.call_size, "calls_at_once": args.calls_at_once, "tasks": args.tasks}
    module, _, name = args.scorer.partition(":")
    factory = getattr(importlib.import_module(module), name)
    if args.distinct:
        return lambda df: score_distinct(df, factory, remember=args.remember, **settings)
    return lambda df: score(df, factory, **settings)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="broker addresses")
    source.add_argument("--messages", help="folder of JSON lines instead of a broker")
    parser.add_argument("--topic", default=broker.TOPIC)
    parser.add_argument("--max-offsets", type=int, help="messages per micro-batch at most")
    parser.add_argument("--min-partitions", type=int, help="split broker partitions over at least as many tasks")
    parser.add_argument("--replays-within", help="leave out messages whose id came before within this time, e.g. '1 hour'")
    parser.add_argument("--store", required=True)
    parser.add_argument("--checkpoint", help="stream state; needed unless --batch")
    parser.add_argument("--trigger", default="10 seconds")
    parser.add_argument("--once", action="store_true", help="work off what is there and stop")
    parser.add_argument("--batch", action="store_true", help="reprocess everything as one batch job")
    parser.add_argument("--scorer", help="module:factory of a scorer; default: keywords, as a native expression")
    parser.add_argument("--model", help="saved classifier in the scorer's place")
    parser.add_argument("--distinct", action="store_true", help="ask once per distinct text (of a micro-batch)")
    parser.add_argument("--remember", help="table of answers that are kept, one per model; with --distinct")
    parser.add_argument("--tasks", type=int, help="spread rows over this many scoring tasks")
    parser.add_argument("--call-size", type=int, default=64, help="texts per call of the scorer")
    parser.add_argument("--calls-at-once", type=int, default=1, help="calls a task waits for at a time")
    parser.add_argument("--attempts", type=int, default=3, help="tries per call")
    parser.add_argument("--rest-after", type=int, default=3, help="failed calls in a row before a task rests")
    parser.add_argument("--rest-seconds", type=float, default=60, help="how long it rests")
    args = parser.parse_args(argv)
    if args.model and args.scorer:
        parser.error("choose one of --model and --scorer")
    for flag in ("distinct", "tasks", "call_size", "calls_at_once", "attempts", "rest_after", "rest_seconds"):
        if not args.scorer and getattr(args, flag) != parser.get_default(flag):
            parser.error(f"--{flag.replace('_', '-')} has an effect with --scorer only")
    if args.remember and not args.distinct:
        parser.error("--remember goes with --distinct")
    if args.batch and args.replays_within:
        parser.error("--replays-within is for streams")
    if not args.batch and not args.checkpoint:
        parser.error("--checkpoint is needed for a stream")

    spark = build_session("moodlake-enrich")
    scoring = _scoring(args)
    if args.batch:
        rows = (
            broker.read_batch(spark, args.servers, topic=args.topic, min_partitions=args.min_partitions)
            if args.servers else spark.read.text(args.messages)
        )
        with scratch_scope(spark):
            write_enriched(enrich.enrich(rows, scoring), args.store)
        return
    rows = (
        broker.read_stream(
            spark, args.servers, topic=args.topic, max_offsets=args.max_offsets, min_partitions=args.min_partitions
        )
        if args.servers else spark.readStream.text(args.messages)
    )
    if args.replays_within:
        rows = enrich.without_replays(rows, args.replays_within)
    trigger = None if args.once else args.trigger
    if args.distinct:
        query = enrich.write_stream_batches(
            rows, lambda batch: enrich.enrich(batch, scoring), args.store, args.checkpoint, trigger
        )
    else:
        query = enrich.write_stream(enrich.enrich(rows, scoring), args.store, args.checkpoint, trigger)
    enrich.run(query)


if __name__ == "__main__":
    main()
