"""Command line: ``python -m footfall STEP --root FOLDER ...`` or through ``spark-submit``."""

from __future__ import annotations

import argparse

from footfall import operators as op
from footfall.operators.cleaning import DATE_END, DATE_START
from footfall.plans import warehouse
from footfall.session import session, streaming_session
from footfall.sinks import preview
from footfall.sources import load_raw
from footfall import streaming


def _days(text: str) -> tuple[int, ...]:
    return tuple(int(day) for day in text.split(","))

#: Rows of a numbered file if only the number of messages is limited.
FILE_ROWS = 100_000


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="footfall", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, **kwargs) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, **kwargs)
        sub.add_argument("--master", help="Spark master; left to spark-submit by default")
        return sub

    for name in ("load", "clean", "summarise", "report", "export", "verify", "all"):
        sub = step(name)
        sub.add_argument("--root", required=True, help="warehouse folder")
        if name in ("load", "all"):
            sub.add_argument("--csv", required=True, help="raw event CSV, file or folder")
        if name in ("clean", "all"):
            sub.add_argument("--start", default=DATE_START)
            sub.add_argument("--tz", default="Asia/Shanghai")
        if name in ("clean", "report", "all"):
            sub.add_argument("--end", default=DATE_END)
        if name in ("report", "export", "all"):
            sub.add_argument(
                "--retention", type=_days, default=(1, 2, 3), metavar="1,2,3", help="days after the first"
            )
        if name == "clean":
            sub.add_argument("--replace-days-only", action="store_true")
        if name == "export":
            sub.add_argument("--out", required=True)
            sub.add_argument("--head", type=int, help="first rows of long tables only")
    for name in ("stream", "land"):
        sub = step(name, help="needs Spark's Kafka connector (--packages or --jars)")
        sub.add_argument("--servers", required=True)
        sub.add_argument("--topic", default=streaming.intake.TOPIC)
        sub.add_argument("--starting-offsets", default="latest")
        sub.add_argument("--batch-size", type=int, help="messages per trigger")
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--once", action="store_true", help="work off what is there and stop")
        if name == "land":
            sub.add_argument("--out", required=True)
            sub.add_argument("--file-rows", type=int, help="numbered files of so many rows at most")
            sub.add_argument("--max-messages", type=int, help="stop after so many messages")
        else:
            sub.add_argument("--late", help="folder for the windows and the events too late for them")
    sub = step("send", help="send a raw CSV as messages")
    sub.add_argument("--servers", required=True)
    sub.add_argument("--topic", default=streaming.intake.TOPIC)
    sub.add_argument("--csv", required=True)
    return parser


def _stream(args: argparse.Namespace) -> None:
    spark = streaming_session(f"footfall-{args.step}", master=args.master)
    events = streaming.decode_messages(
        streaming.kafka_messages(
            spark, args.servers, args.topic, args.starting_offsets, args.batch_size
        )
    )
    totals = streaming.RunTotals()
    spark.streams.addListener(totals)
    once = {"every": None} if args.once else {}
    if args.step == "stream" and args.late:
        query = streaming.start_with_late(events, args.late, args.checkpoint, **once)
    elif args.step == "stream":
        query = streaming.start_windowed(streaming.windowed_pv_uv(events), args.checkpoint, **once)
    elif args.file_rows or args.max_messages:
        query, files = streaming.land_numbered(
            events, args.out, args.checkpoint, args.file_rows or FILE_ROWS, args.max_messages, **once
        )
        streaming.finish_landing(query, files)
    else:
        query = streaming.land_batches(events, args.out, args.checkpoint, **once)
    streaming.run_until_interrupted(query)
    print(totals.of(query))


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    if args.step in ("stream", "land"):
        return _stream(args)
    spark = session(f"footfall-{args.step}", master=args.master)
    if args.step == "send":
        events = load_raw(spark, args.csv, drop_malformed=True)
        options = {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
        return streaming.write_messages(events, **options)
    if args.step in ("load", "all"):
        warehouse.build_raw(spark, args.csv, args.root)
        preview(op.behavior_share(warehouse.read_layer(spark, warehouse.RAW_TABLE, args.root)))
    if args.step in ("clean", "all"):
        audit = warehouse.build_detail(
            spark,
            args.root,
            args.start,
            args.end,
            args.tz,
            getattr(args, "replace_days_only", False),
        )
        if audit is not None:
            preview(audit)
    if args.step in ("summarise", "all"):
        warehouse.build_summaries(spark, args.root)
    if args.step in ("report", "all"):
        warehouse.build_reports(spark, args.root, args.end, offsets=args.retention)
    if args.step == "export":
        warehouse.export_reports(spark, args.out, args.root, head=args.head, offsets=args.retention)
    if args.step in ("verify", "all"):
        for result in warehouse.verify(spark, args.root).values():
            preview(result, 30)


if __name__ == "__main__":
    main()
