"""Compacts the keyed tables, expires their change feeds and cleans up."""

from datetime import timedelta

from jobs.common import parser

from adlake.session import build_session
from adlake.tables.lake import Lake
from adlake.tables.maintenance import ACTIONS, RETAIN_LAST, TARGET_BYTES, maintain


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--action", choices=ACTIONS, default="all")
    args.add_argument("--tables", nargs="*", choices=["silver", "hourly", "daily"])
    args.add_argument("--target-file-size-bytes", type=int, default=TARGET_BYTES)
    args.add_argument("--change-retention-days", type=int, default=7)
    args.add_argument("--change-retain-last", type=int, default=RETAIN_LAST)
    args.add_argument("--orphan-retention-days", type=int, default=3)
    args.add_argument("--dry-run", action="store_true")
    args = args.parse_args(argv)

    tables = Lake(build_session("maintenance"), args.root).upsert_tables()
    outcomes = maintain(
        [tables[name] for name in args.tables or tables],
        args.action,
        args.target_file_size_bytes,
        timedelta(days=args.change_retention_days),
        args.change_retain_last,
        timedelta(days=args.orphan_retention_days),
        args.dry_run,
    )
    for path, action, outcome in outcomes:
        print(path, action, outcome)


if __name__ == "__main__":
    main()
