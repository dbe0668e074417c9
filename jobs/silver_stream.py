"""Streams Bronze into the Silver table."""

from jobs.common import parser

from adlake.session import build_session
from adlake.sources.bronze import bronze_stream
from adlake.streaming.queries import start_silver
from adlake.tables.lake import Lake


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--max-files", type=int, default=20, help="Bronze files a trigger")
    args.add_argument("--trigger", default="30 seconds")
    args.add_argument("--once", action="store_true", help="read what is there, then stop")
    args = args.parse_args(argv)

    lake = Lake(build_session("bronze-to-silver"), args.root)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    start_silver(lake, bronze_stream(lake.spark, lake.bronze_path, args.max_files), trigger).awaitTermination()


if __name__ == "__main__":
    main()
