"""Runs the health checks and stores their results."""

from jobs.common import moment, parser

from adlake.plans.health import run_health
from adlake.session import build_session
from adlake.tables.lake import Lake


def main(argv=None) -> None:
    args = parser(__doc__)
    args.add_argument("--as-of", help="ISO time to look from; now by default")
    args = args.parse_args(argv)
    for row in run_health(Lake(build_session("health-check"), args.root), moment(args.as_of)).toLocalIterator():
        print(*row, sep="\t")


if __name__ == "__main__":
    main()
