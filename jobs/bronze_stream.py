"""Streams raw messages into Bronze."""

from jobs.common import options, parser

from adlake.session import build_session
from adlake.sources.messages import raw_stream
from adlake.streaming.queries import start_bronze
from adlake.tables.lake import Lake


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--format", default="kafka")
    args.add_argument(
        "--option", action="append",
        help="name=value for the source, such as kafka.bootstrap.servers, subscribe, maxOffsetsPerTrigger",
    )
    args.add_argument("--trigger", default="30 seconds")
    args.add_argument("--once", action="store_true", help="read what is there, then stop")
    args = args.parse_args(argv)

    lake = Lake(build_session("kafka-to-bronze"), args.root)
    source = options(args.option)
    if args.format != "kafka":
        source = {"path": f"{args.root}/feed", **source}
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    start_bronze(lake, raw_stream(lake.spark, args.format, source), trigger).awaitTermination()


if __name__ == "__main__":
    main()
