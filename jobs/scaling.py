"""Recommends an executor limit for each streaming job."""

from jobs.common import moment, parser

from adlake.functions.exprs import as_utc
from adlake.plans.scaling import LAG_WINDOW, STREAMING_QUERIES, decide, max_duration, recorded_lag
from adlake.session import build_session
from adlake.tables.lake import Lake


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--current-max", type=int, required=True)
    args.add_argument("--as-of", help="ISO time to look from; now by default")
    args = args.parse_args(argv)

    lake = Lake(build_session("streaming-scaling"), args.root)
    spark, now = lake.spark, as_utc(moment(args.as_of))
    apps = spark.createDataFrame([(name, args.current_max) for name in STREAMING_QUERIES], "app string, current_max int")
    lag = recorded_lag(lake.topic_offsets.since(now - LAG_WINDOW), now)
    apps = apps.join(lag, apps["app"] == lag["query_name"], "left").drop("query_name")
    recent = lake.batch_metrics.since(now - LAG_WINDOW)
    decide(apps, duration=max_duration(recent, now)).show(truncate=False)


if __name__ == "__main__":
    main()
