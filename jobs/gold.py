"""Aggregates Silver events into the Gold tables."""

from jobs.common import parser

from adlake.operators.kpis import events_without_campaign
from adlake.plans.gold import build_gold, rebuild_changed
from adlake.session import build_session
from adlake.tables.lake import Lake


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--start-date", help="inclusive; yesterday (UTC) by default")
    args.add_argument("--end-date", help="inclusive; the start date by default")
    args.add_argument("--mode", choices=["merge", "replace"], default="merge")
    args.add_argument("--changed", action="store_true", help="the dates that Silver's batches changed since the last such run")
    args = args.parse_args(argv)

    lake = Lake(build_session("silver-to-gold"), args.root)
    if args.changed:
        print(*sorted(rebuild_changed(lake)))
        return
    build_gold(lake, args.start_date, args.end_date, args.mode)
    for row in events_without_campaign(lake.silver.read(args.start_date, args.end_date)).orderBy("event_date").toLocalIterator():
        print(row["event_date"], row["events_without_campaign"])


if __name__ == "__main__":
    main()
