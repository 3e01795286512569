"""Run the feed jobs: ``spark-submit --packages <kafka connector> ... -m wattline`` or ``python -m wattline``.

    (--servers HOST:PORT | --files DIR) --checkpoints DIR (--out DIR | --format NAME [--option K=V ...])
    [--feed NAME[=TOPIC] ...] [--starting earliest|latest] [--max-offsets N] [--min-partitions N]
    [--dead-letters DIR [--keyed table|state|history [--buckets N] [--compact-every N]] | --outcomes] [--lenient] [--attempts N] [--keep-failed-batches]
    [--join device-telemetry --state-partitions N [--within T] [--lateness T] [--salts N]]
    [--trigger TIME | --available-now] [--pools]

Without ``--feed`` the eight standing feeds run on their usual topics. ``--files`` reads topics archived as Parquet
folders of their names. With ``--join`` devices are joined with their telemetry instead. ``--pools`` needs
``spark.scheduler.mode=FAIR``: without it the feeds share one queue, and a backlog in one delays all others.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from wattline.contracts import DEVICE, DEVICE_TELEMETRY, TELEMETRY, Feed, Table, feed
from wattline.sources import message_files, read_feed, resolve_topics
from wattline.streaming.jobs import QUERY_NAMES, device_telemetry_job, feed_jobs, keyed_sink
from wattline.streaming.runner import run_available, run_until_stopped, stateful_session
from wattline.streaming.sinks import Sink, external_sink, files_sink


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wattline", description="Run feed jobs.")
    parser.add_argument("--servers")
    parser.add_argument("--files", help="folder of topics archived as Parquet")
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--out")
    parser.add_argument("--format")
    parser.add_argument("--option", action="append", default=[], metavar="K=V")
    parser.add_argument("--table-option", default="table", help="connector option that names the table")
    parser.add_argument("--null-option", help="connector option that leaves stored values under nulls")
    parser.add_argument("--feed", action="append", default=[], metavar="NAME[=TOPIC]")
    parser.add_argument("--starting", default="earliest")
    parser.add_argument("--max-offsets", type=int, help="messages (with --files: files) of a micro-batch")
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--keyed", choices=("table", "state", "history"), help="write keyed tables, not append logs")
    parser.add_argument("--buckets", type=int, default=64, help="partitions of a keyed table without dates")
    parser.add_argument("--compact-every", type=int, default=16, help="batches between merges of such a table's log")
    parser.add_argument("--dead-letters")
    parser.add_argument("--outcomes", action="store_true", help="good and bad rows in one pass into the append log")
    parser.add_argument("--lenient", action="store_true", help="badly typed fields are null, not dead letters")
    parser.add_argument("--attempts", type=int, default=1)
    parser.add_argument("--keep-failed-batches", action="store_true")
    parser.add_argument("--join", choices=("device-telemetry",))
    parser.add_argument("--state-partitions", type=int, help="partitions of the join's state, for its whole life")
    parser.add_argument("--within", default="30 days")
    parser.add_argument("--lateness", default="1 day")
    parser.add_argument("--salts", type=int, default=8)
    parser.add_argument("--trigger", metavar="TIME", help="time between micro-batches")
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--pools", action="store_true")
    parsed = parser.parse_args(argv)
    for one, other in (("out", "format"), ("servers", "files")):
        if (getattr(parsed, one) is None) == (getattr(parsed, other) is None):
            parser.error(f"give either --{one} or --{other}")
    if parsed.join and not parsed.state_partitions:
        parser.error("--join needs --state-partitions")
    if (parsed.keyed or parsed.outcomes) and not parsed.out:
        parser.error("--keyed and --outcomes write to --out")
    if parsed.keyed and not parsed.dead_letters:
        parser.error("--keyed needs --dead-letters: a row without its key has no place in a keyed table")
    return parsed


def chosen_topics(given: list[str]) -> dict[str, str]:
    """Feed name to topic; a bare name means the feed's usual topic."""
    topics = {}
    for item in given or list(QUERY_NAMES):
        name, equals, topic = item.partition("=")
        topics[name] = topic if equals else feed(name).topic
    return resolve_topics(topics, topics)


def sink_maker(args: argparse.Namespace):
    """Where a feed's rows go: a keyed table, an append log under their dates, or a store through its connector."""

    def make(which: Feed) -> Sink:
        table = which.table
        if args.out and args.keyed:
            target = f"{args.out.rstrip('/')}/{table.name}"
            return keyed_sink(which, target, args.keyed, buckets=args.buckets, compact_every=args.compact_every)
        if args.out:
            dates = [name for name in table.partition if table.types[name] == "date"]
            return files_sink(f"{args.out.rstrip('/')}/{table.name}", partition_by=dates)
        return store_sink(args, table)

    return make


def store_sink(args: argparse.Namespace, table: Table) -> Sink:
    options = dict(item.split("=", 1) for item in args.option)
    named = {**options, args.table_option: table.name}
    return external_sink(args.format, table, options=named, null_option=args.null_option)


def source(args: argparse.Namespace, spark: SparkSession, which: Feed, topic: str) -> DataFrame:
    if args.files:
        path = f"{args.files.rstrip('/')}/{topic}"
        return message_files(spark, path, stream=True, max_files_per_trigger=args.max_offsets)
    return read_feed(
        spark,
        which,
        args.servers,
        topic=topic,
        starting=args.starting,
        max_offsets_per_trigger=args.max_offsets,
        min_partitions=args.min_partitions,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("wattline").getOrCreate().newSession()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.join:
        topics = chosen_topics(args.feed or [DEVICE.name, TELEMETRY.name])
        spark = stateful_session(spark, args.state_partitions)
        devices, telemetry = (source(args, spark, which, topics[which.name]) for which in (DEVICE, TELEMETRY))
        table = DEVICE_TELEMETRY
        sink = files_sink(f"{args.out}/{table.name}") if args.out else store_sink(args, table)
        jobs = [
            device_telemetry_job(
                devices, telemetry, sink, within=args.within, lateness=args.lateness, salts=args.salts
            )
        ]
    else:
        topics = chosen_topics(args.feed)
        jobs = feed_jobs(
            {name: source(args, spark, feed(name), topic) for name, topic in topics.items()},
            sink_maker(args),
            keyed=args.keyed in ("state", "history"),
            dead_letters=args.dead_letters,
            outcomes=args.outcomes,
            strict=not args.lenient,
            attempts=args.attempts,
            keep_failed_batches=args.keep_failed_batches,
            pools=args.pools,
        )
    if args.available_now:
        run_available(spark, jobs, args.checkpoints)
    else:
        trigger = {"processingTime": args.trigger} if args.trigger else None
        run_until_stopped(spark, jobs, args.checkpoints, trigger=trigger)


if __name__ == "__main__":
    main()
