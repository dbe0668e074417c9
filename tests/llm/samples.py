"""Invented texts for the tests."""

from __future__ import annotations

import random


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Words of a small invented vocabulary, eight to a line."""
    draw = random.Random(seed)
    out = [f"w{draw.randrange(vocabulary)}x" for _ in range(words)]
    return "\n".join(" ".join(out[at : at + 8]) + "." for at in range(0, words, 8))
