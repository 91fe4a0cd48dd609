"""Starts a job: ``python -m dwelltide.plans.run JOB --help``, or the same by spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from dwelltide.plans.device_features import (
    EARLY_EVERY,
    LATENESS,
    SESSION_GAP,
    JobFolders,
    start_final,
    start_running,
)
from dwelltide.plans.printing import (
    await_any,
    start_client_and_event_print,
    start_text_print,
)
from dwelltide.sources.streams import preset, text_stream
from dwelltide.streaming.metrics import metrics_table


def _option(text: str) -> tuple[str, str]:
    key, equals, value = text.partition("=")
    if not equals:
        raise argparse.ArgumentTypeError(f"expected key=value, not {text!r}")
    return key, value


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="dwelltide.plans.run", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--streams", required=True, help="folder of the input streams")
    common.add_argument("--option", type=_option, action="append", default=[], metavar="KEY=VALUE")
    common.add_argument("--once", action="store_true", help="stop at the end of present input")

    typed = argparse.ArgumentParser(add_help=False)
    typed.add_argument("--format", default="parquet")
    typed.add_argument("--decoder", choices=["text", "json", "binary"])
    typed.add_argument("--starting", choices=["latest", "earliest"])

    features = jobs.add_parser("device-features", parents=[common, typed])
    features.add_argument("--jobs", required=True, help="folder of the jobs' own folders")
    features.add_argument("--name", default="device_features")
    features.add_argument("--gap", default=SESSION_GAP)
    features.add_argument("--lateness", default=LATENESS)
    features.add_argument("--every", default=EARLY_EVERY)
    features.add_argument("--final", action="store_true", help="closed sessions only")
    features.add_argument("--state-partitions", type=int)
    features.add_argument("--writers", type=int, help="files per micro-batch")
    features.add_argument("--buckets", type=int, default=256, help="of the feature table")
    features.add_argument("--state", choices=["keyed", "table"], default="keyed", help="of open sessions")
    features.add_argument("--fire-every", help="emit all open sessions that often; state table only")
    features.add_argument("--merge-late", action="store_true", help="with --final: late rows join open sessions")
    features.add_argument("--quarantine", action="store_true", help="keep what cannot be decoded")
    features.add_argument("--metrics-every", type=int, default=1, help="reports per write")

    printing = jobs.add_parser("print-clients-and-events", parents=[common, typed])
    printing.add_argument("--raw-schema", required=True, help="columns of the raw events")
    printing.add_argument("--to", help="folder to write to, instead of the console")

    lines = jobs.add_parser("print-text", parents=[common])
    lines.add_argument("--to", help="folder to write to, instead of the console")
    return parser.parse_args(argv)


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    options = dict(args.option)
    trigger = {"availableNow": True} if args.once else None
    if args.job == "print-text":
        lines = text_stream(args.streams).source(spark, options)
        return [start_text_print(lines, folder=args.to, trigger=trigger)]

    how = {"format": args.format, "decoder": args.decoder, "options": options}
    if args.job == "print-clients-and-events":
        logs = preset("client_log", args.streams, **how)
        events = preset("raw", args.streams, args.raw_schema, **how)
        return list(
            start_client_and_event_print(
                logs.source(spark), events.source(spark), folder=args.to, trigger=trigger
            )
        )
    flat = preset("flat", args.streams, starting=args.starting, **how)
    settings = {"writers": args.writers, "state_partitions": args.state_partitions}
    if args.final:
        settings["merge_late"] = args.merge_late
    else:
        settings |= {"buckets": args.buckets, "state": args.state, "fire_every": args.fire_every}
    return [
        (start_final if args.final else start_running)(
            spark,
            flat.source(spark, quarantine=args.quarantine),
            folders(args),
            args.gap,
            args.lateness,
            trigger=trigger or {"processingTime": args.every},
            **settings,
        )
    ]


def folders(args: argparse.Namespace) -> JobFolders:
    return JobFolders(args.jobs, args.name)


def _await(spark: SparkSession, queries: list[StreamingQuery], once: bool) -> None:
    if not once:
        await_any(spark)
    for query in queries if once else ():
        query.awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"dwelltide {args.job}").getOrCreate()
    if args.job != "device-features":
        _await(spark, start(spark, args), args.once)
        return
    own = folders(args).final if args.final else folders(args)
    with metrics_table(spark, own.metrics, args.metrics_every):
        _await(spark, start(spark, args), args.once)


if __name__ == "__main__":
    main()
