"""Finds benchmark items in documents, allowing for edits."""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.shared import add_columns, stored

WORD = re.compile(r"[^\W_]+")
GROUP_CHARS = 2_000_000  # of items looked for in one pass; some 140 MB in a worker
LEAST_CHARS = 24  # of an item that may have edits
LEAST_EXACT = 8  # of a shorter item that is found word for word
ERROR_SHARE = 1 / 16
WIDE = re.compile("[\u2e80-\uffef\U00020000-\U0003ffff]")  # writing of which a character is a word or a syllable


def normal(text: str) -> str:
    """Lower case, words of letters and digits, one blank between."""
    return " ".join(WORD.findall(text.lower()))


def weight(text: str) -> int:
    """Characters, those of word and syllable writing as three."""
    return len(text) + 2 * len(WIDE.findall(text))


def distance_within(pattern: str, masks: dict[str, int], text: str, budget: int) -> bool:
    """Whether some part of the text is within the edit budget of the pattern.

    Myers' bit-parallel columns: bit i tells how the distance of the pattern's
    first i + 1 characters differs from that of the first i.
    """
    last, full = 1 << (len(pattern) - 1), (1 << len(pattern)) - 1
    up, down, distance = full, 0, len(pattern)
    for char in text:
        equal = masks.get(char, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        rise = down | (full & ~(horizontal | up))
        fall = up & horizontal
        if rise & last:
            distance += 1
        elif fall & last:
            distance -= 1
            if distance <= budget:
                return True
        rise, fall = rise << 1, fall << 1
        up = (fall | ~(vertical | rise)) & full
        down = rise & vertical & full
    return distance <= budget


class Items:
    """Test items cut into one piece more than their error budget.

    With so few errors one piece at least stands in the text unchanged, so
    exact hits of the pieces miss nothing.
    """

    def __init__(self, items: list[tuple[int, str]], error_share: float, least_chars: int = LEAST_CHARS):
        self.items, self.masks, pieces = [], [], {}
        for number, text in items:
            # A short item has no errors, and stands between word borders.
            budget = int(len(text) * error_share) if len(text) >= least_chars else None
            cuts = [len(text) * at // ((budget or 0) + 1) for at in range((budget or 0) + 2)]
            for start, end in zip(cuts, cuts[1:]):
                pieces.setdefault(text[start:end], []).append((len(self.items), start))
            masks: dict[str, int] = {}
            for at, char in enumerate(text):
                masks[char] = masks.get(char, 0) | 1 << at
            self.items.append((number, text, budget))
            self.masks.append(masks)
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def found(self, text: str) -> list[int]:
        """Numbers of the items in a text."""
        text, hits, seen = normal(text), set(), set()
        for end, (length, places) in self.automaton.iter(text):
            for at, offset in places:
                number, item, budget = self.items[at]
                start = end + 1 - length - offset
                if number in hits or (at, start) in seen:
                    continue
                seen.add((at, start))
                if budget is None:
                    if text[start - 1 : start] in ("", " ") and text[end + 1 : end + 2] in ("", " "):
                        hits.add(number)
                    continue
                around = text[max(0, start - budget) : start + len(item) + budget]
                if distance_within(item, self.masks[at], around, budget):
                    hits.add(number)
        return sorted(hits)


def unsearched(items: DataFrame) -> DataFrame:
    """Items that are never looked for: null or too short once normalised."""

    def start():
        return lambda texts: [[text is None or weight(normal(text)) < LEAST_EXACT for text in texts]]

    return add_columns(items, "text", {"_unsearched": "boolean"}, start).where("_unsearched OR item_id IS NULL").drop("_unsearched")


def match_items(docs: DataFrame, items: DataFrame, error_share: float = ERROR_SHARE, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Adds ``matched_items``: the sorted item_ids found in each whole text.

    ``items`` has item_id and text. Both sides are compared in lower case, as
    words with one blank between. An item is found where a part of the text is
    within floor(length * error_share) edits of the whole item. Items of fewer
    than ``least_chars`` normal characters are found word for word, between
    word borders. Items with a null id or text take no part, nor do those that
    ``unsearched`` tells: so short that any text could hold them by chance.
    Items that repeat are all told. A null or empty text matches nothing. Other
    columns pass through, whatever their names.

    Items are broadcast in groups of about ``GROUP_CHARS`` characters, a pass
    over the documents for each that ends in a written table, so a worker holds
    one group at a time.
    """
    usable = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_CHARS))
    dealt = usable.withColumn("group", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    out, parts, own = docs.drop("matched_items"), [], "_matched"
    while any(name.startswith(own) for name in docs.columns):
        own = f"_{own}"
    for group in range(groups):
        known = [(row["item_id"], normal(row["text"])) for row in dealt.where(F.col("group") == group).toLocalIterator()]
        known = [(number, text) for number, text in known if weight(text) >= LEAST_EXACT]
        shared = docs.sparkSession.sparkContext.broadcast(known)

        def start(shared=shared):
            search = Items(shared.value, error_share, least_chars) if shared.value else None

            def run(texts: list[str | None]) -> list:
                return [[search.found(text) if search and text else [] for text in texts]]

            return run

        if parts:
            out = stored(out, "matched")
        parts.append(f"{own}_{group}")
        out = add_columns(out, "text", {parts[-1]: "array<long>"}, start)
    return out.withColumn("matched_items", F.array_sort(F.flatten(F.array(*parts)))).drop(*parts)
