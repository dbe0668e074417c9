from __future__ import annotations

import hashlib
import random

import pytest

from adlake.llm import suffix_dedup
from adlake.llm.shared import utf8
from adlake.llm.suffix_dedup import dedup_bytes


def brute(rows):
    """Kept bytes and runs of (doc_id, text) rows with distinct ids."""
    seen, out = set(), {}
    for number, text in sorted(rows, key=lambda row: (row[0] is not None, row[0])):
        whole = utf8(text)
        gone = bytearray(len(whole))
        for at in range(len(whole) - 99):
            if whole[at : at + 100] in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(whole[at : at + 100])
        kept = bytes(b for b, g in zip(whole, gone) if not g)
        runs = sum(1 for at in range(len(whole)) if gone[at] and not (at and gone[at - 1]))
        out[number] = (len(whole), len(whole) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept)
    return out


def corpus():
    draw = random.Random(4)
    word = lambda n: "".join(draw.choices("abcde é", k=n))
    base, passage = word(900), word(260)
    rows = [(1, base), (2, base[:400] + "#" + base[400:]), (3, word(50) + passage), (4, passage + word(80)), (5, base), (6, "a" * 400), (7, "ab" * 200)]
    rows += [(10 + at, word(30 + at) + passage + word(60)) for at in range(25)]
    return rows + [(60, base[100:199]), (61, base[100:200]), (62, base[100:200] * 3), (None, passage[:150]), (63, None), (64, "")]


@pytest.mark.parametrize("most, rows", [(4096, 30_000), (8, 20)])
def test_against_all_strings(make, monkeypatch, most, rows):
    monkeypatch.setattr(suffix_dedup, "MOST_SUFFIXES", most)
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", rows)
    found = {row["doc_id"]: tuple(row)[1:] for row in dedup_bytes(make(corpus())).collect()}
    expected = brute(corpus())
    assert {key: (*value[:4], bytes(value[4])) for key, value in found.items()} == expected


@pytest.mark.parametrize("most", [4096, 1])
def test_repeated_rows_are_one_document(make, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_SUFFIXES", most)
    draw = random.Random(9)
    word = lambda n: "".join(draw.choices("abcde é", k=n))
    lone, copied = word(300), word(200)
    rows = [(1, lone), (2, copied), (3, copied), (None, word(150)), (4, word(40) + lone[:120]), (5, lone[150:280] * 2), (5, word(130))]
    expected = {(key, value[0]): value[1:] for row in (rows[:-1], rows[-1:]) for key, value in brute(row).items()}
    found = dedup_bytes(make(rows * 2 + rows[:1] * 3)).collect()
    assert len(found) == 2 * len(rows) + 3
    for row in found:
        assert (*tuple(row)[2:5], bytes(row["kept"])) == expected[row["doc_id"], row["n_bytes"]]


def test_odd_rows(odd, empty):
    rows = dedup_bytes(odd).collect()
    assert len(rows) == odd.count()
    same = [tuple(row)[1:5] for row in rows if row["doc_id"] == 6]
    assert same[0] == same[1] and same[0][1] == same[0][0]
    assert dedup_bytes(empty).count() == 0
