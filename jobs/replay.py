"""Replays a source log as event messages, to a broker or a folder of files."""

import time

from jobs.common import options, parser
from pyspark.sql import functions as F

from adlake.operators.projections import coerce, to_events, to_raw_messages
from adlake.session import build_session
from adlake.sources.messages import as_feed, publish
from adlake.sources.source_log import read_source_log


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--input", required=True, help="tab-separated log: a file, or a folder of files")
    args.add_argument("--format", default="kafka")
    args.add_argument("--option", action="append", help="name=value for the writer")
    args.add_argument("--topic", default="ad-events")
    args.add_argument("--partitions", type=int, default=6, help="only without a broker")
    args.add_argument("--base-epoch", type=float, help="start of the log's clock; now by default")
    args.add_argument("--start-line", type=int, default=0)
    args.add_argument("--max-events", type=int, default=0)
    args = args.parse_args(argv)

    spark = build_session("replay")
    base_epoch = args.base_epoch if args.base_epoch is not None else time.time()
    rows = read_source_log(spark, args.input, args.start_line, args.max_events)
    good, rejected = coerce(rows)
    messages = to_raw_messages(to_events(good, base_epoch), "line_number")
    if args.format == "kafka":
        target = {"topic": args.topic, **options(args.option)}
        publish(messages.select("key", "value"), "kafka", target)
    else:
        feed = as_feed(messages, args.topic, args.partitions, "line_number", F.current_timestamp())
        publish(feed, args.format, {"path": f"{args.root}/feed", **options(args.option)})
    rejected.write.mode("append").parquet(f"{args.root}/quarantine/source_log")


if __name__ == "__main__":
    main()
