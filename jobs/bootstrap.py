"""Creates namespaces and empty tables; safe to run again."""

from jobs.common import parser

from adlake.session import build_session
from adlake.tables.lake import bootstrap


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--bronze-table", help="also register Bronze as an external table of this name")
    args = args.parse_args(argv)
    bootstrap(build_session("bootstrap"), args.root, args.bronze_table)


if __name__ == "__main__":
    main()
