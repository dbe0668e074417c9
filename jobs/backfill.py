"""Rebuilds Silver for a date range from Bronze, and optionally Gold after it."""

from jobs.common import parser

from adlake.plans.backfill import backfill_and_rebuild, backfill_silver
from adlake.session import build_session
from adlake.tables.lake import Lake


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--event-start-date", required=True)
    args.add_argument("--event-end-date", required=True)
    args.add_argument("--bronze-start-date")
    args.add_argument("--bronze-end-date")
    args.add_argument("--rebuild-gold", action="store_true")
    args = args.parse_args(argv)

    lake = Lake(build_session("backfill-silver"), args.root)
    bounds = (args.event_start_date, args.event_end_date, args.bronze_start_date, args.bronze_end_date)
    if args.rebuild_gold:
        backfill_and_rebuild(lake, *bounds)
    else:
        backfill_silver(lake, *bounds)


if __name__ == "__main__":
    main()
