"""Arguments the jobs share. Run a job from the repository root: python -m jobs.<name>."""

from __future__ import annotations

import argparse
from datetime import datetime


def parser(description: str) -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description=description)
    args.add_argument("--root", required=True, help="folder of the lake, shared by all jobs")
    return args


def options(pairs: list[str] | None) -> dict[str, str]:
    """``name=value`` arguments as a dict."""
    return dict(pair.split("=", 1) for pair in pairs or [])


def moment(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None
