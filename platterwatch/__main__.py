"""Command line: ``python -m platterwatch {1,2,replay} --input FILES --output FOLDER``.

1 and 2 run that query on telemetry lines; replay turns a CSV dataset into lines to stream.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from platterwatch import schema
from platterwatch.operators.windows import DayWindow
from platterwatch.plans.jobs import FORMS, SINKS, batch_job, stream_job
from platterwatch.plans.replay import replay_dataset
from platterwatch.session import session
from platterwatch.sources.lines import read_lines, read_lines_stream
from platterwatch.sources.replay import is_replay


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="platterwatch", description=__doc__)
    parser.add_argument("query", choices=("1", "2", "replay"))
    parser.add_argument("--input", help="folder of line files, or the dataset to replay")
    parser.add_argument("--kafka", help="Kafka servers, in place of --input (replay: of --output)")
    parser.add_argument("--topic", help="default: filtered, for a replay: original")
    parser.add_argument("--kafka-option", nargs=2, action="append", default=[])
    parser.add_argument("--output", help="folder of the results")
    parser.add_argument("--stream", action="store_true", help="treat --input as a stream")
    parser.add_argument("--checkpoint", help="folder for stream checkpoints")
    parser.add_argument("--once", action="store_true", help="stop when the input is used up")
    parser.add_argument("--every", default=schema.TRIGGER)
    parser.add_argument("--delay", default=schema.WATERMARK_DELAY)
    parser.add_argument("--live", action="store_true", help="query 2: rank with every micro-batch")
    parser.add_argument("--overall", action="store_true", help="query 2: over all closed windows")
    parser.add_argument("--sink", choices=SINKS, default="files", help="of a stream's results")
    parser.add_argument("--collection", nargs=2, metavar=("URI", "DATABASE"))
    parser.add_argument("--day-precision", action="store_true", help="cut event times to the day")
    parser.add_argument("--max-files", type=int, help="files per micro-batch")
    parser.add_argument("--state-partitions", type=int, help="fixed by the first start")
    parser.add_argument("--form", choices=FORMS, default="lines")
    parser.add_argument("--days", type=int, nargs="+", default=list(schema.WINDOW_DAYS))
    parser.add_argument("--origin", type=date.fromisoformat, default=schema.DATASET_START)
    parser.add_argument("--range", type=int, nargs=2, default=list(schema.VAULT_RANGE))
    parser.add_argument("--parts", type=int, default=1, help="query 2: lists per ranked group")
    parser.add_argument("--rounded", action="store_true", help="replay: one rounded step per day")
    parser.add_argument("--rejects", help="folder for lines that cannot be used")
    parser.add_argument("--top", type=int, default=schema.TOP_K)
    parser.add_argument("--flush-at", type=datetime.fromisoformat, default=schema.FLUSH_AT)
    args = parser.parse_args(argv)
    if args.query == "replay":
        if not args.input or bool(args.output) == bool(args.kafka):
            parser.error("a replay needs --input, and either --output or --kafka")
        return args
    if bool(args.input) == bool(args.kafka):
        parser.error("give either --input or --kafka")
    if not args.output:
        parser.error("give --output")
    streamed = args.stream or args.kafka
    if not streamed and (args.live or args.overall or args.sink != "files"):
        parser.error("--live, --overall and --sink are for streams")
    if args.live and args.overall:
        parser.error("give either --live or --overall")
    if (args.live or args.overall) and args.query != "2":
        parser.error("--live and --overall are for query 2")
    if args.sink == "collection" and not args.collection:
        parser.error("--sink collection needs --collection")
    if (args.stream or args.kafka) and not args.checkpoint:
        parser.error("a stream needs --checkpoint")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = session(f"platterwatch {args.query}")
    if args.query == "replay":
        replay_dataset(
            spark,
            args.input,
            args.output,
            servers=args.kafka,
            topic=args.topic or "original",
            flush_at=args.flush_at,
            exact=not args.rounded,
            options=dict(args.kafka_option),
        )
        return
    number = int(args.query)
    common = {
        "windows": [DayWindow(days, args.origin) for days in args.days],
        "form": args.form,
        "lo": args.range[0],
        "hi": args.range[1],
        "k": args.top,
        "rejects": args.rejects,
        "parts": args.parts,
        "day_precision": args.day_precision,
    }
    if args.stream or args.kafka:
        replayed = not args.kafka and is_replay(spark, args.input)
        lines = read_lines_stream(
            spark,
            kind="kafka" if args.kafka else "replay" if replayed else "files",
            path=args.input,
            servers=args.kafka,
            topic=args.topic or "filtered",
            max_files=args.max_files,
            options=dict(args.kafka_option),
            offered=f"{args.checkpoint.rstrip('/')}/replay/offered",
        )
        stream_job(
            spark,
            lines,
            number,
            args.output,
            args.checkpoint,
            live=args.live,
            overall=args.overall,
            sink=args.sink,
            collection=args.collection,
            delay=args.delay,
            every=None if args.once else args.every,
            drain=args.once and replayed,
            state_partitions=args.state_partitions,
            **common,
        )
    else:
        batch_job(spark, read_lines(spark, args.input), number, args.output, **common)


if __name__ == "__main__":
    main()
