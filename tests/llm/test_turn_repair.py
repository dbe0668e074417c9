from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from adlake.llm import turn_repair
from adlake.llm.turn_repair import align_block, audit_conversations, damage, repair, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string"
SOUND = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256().hexdigest()


def cheapest(turns: str):
    """All edit sequences, state by state: (cost, audit) of the best one."""
    after = {("-", "s"): "s", ("-", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"-": (0, "")}

    def better(found, state, way):
        if state not in found or way < found[state]:
            found[state] = way

    def inserted(states):
        states = dict(states)
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                for role in "ua":
                    if (state, role) in after:
                        better(states, after[state, role], (cost + 3, audit + "I"))
        return states

    for turn in turns:
        found = {}
        for state, (cost, audit) in inserted(best).items():
            better(found, state, (cost + 4, audit + "D"))
            if turn != "x":
                more = 3 if turn.isupper() else 0
                for role in "sua":
                    if (state, role) not in after:
                        continue
                    if role == turn.lower():
                        better(found, after[state, role], (cost + more, audit + "K"))
                    elif role != "s":
                        better(found, after[state, role], (cost + 3 + more, audit + "R"))
        best = found
    return min(way for state, way in inserted(best).items() if state in "-a")


def crc(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def brute(rows, damaged=True):
    groups = {}
    for conv, turn, role, text in rows:
        here = groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = crc(conv, turn) if damaged else 9
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            here += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, here in groups.items():
        here.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
        seen, letters, counts = set(), "", [0, 0, 0]
        for _, role, text in here:
            written = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not written else 1 if (role, text) in seen else 2 if written[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if fault in (0, 1) else letter.upper() if fault == 2 else letter
        cost, audit = cheapest(letters)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(here))
        turns = {turn for turn, _, _ in here if turn is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        length, left, lines = len(audit.replace("D", "")), iter(here), []
        for edit in audit:
            _, role, text = ("", "", "") if edit == "I" else next(left)
            if edit != "D":
                number = len(lines) + 1 - length % 2  # odd for user, even for assistant
                lines.append(f"{role if edit == 'K' else 'user' if number % 2 else 'assistant'}:{text}")
        assert SOUND.fullmatch("".join(line[0] for line in lines))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_alignment_is_the_cheapest_for_all_short_conversations():
    for length in range(5):
        for turns in itertools.product("suaoxSUAO", repeat=length):
            assert repair("".join(turns)) == cheapest("".join(turns))


def test_blocks_join_exactly(monkeypatch):
    draw = random.Random(1)
    for size in (1, 2, 5):
        monkeypatch.setattr(turn_repair, "BLOCK_TURNS", size)
        align_block.cache_clear()
        for _ in range(300):
            turns = "".join(draw.choice("uauasxUAo") for _ in range(draw.randrange(14)))
            assert repair(turns) == cheapest(turns)
    monkeypatch.setattr(turn_repair, "BLOCK_TURNS", 32)
    align_block.cache_clear()
    turns = "".join(draw.choice("uauasxUAo") for _ in range(700))
    assert repair(turns) == cheapest(turns)


def test_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert rows_of(audit_conversations(damage(table))) == brute([tuple(row) for row in table.collect()])


def invented(seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No!  ", "maybe", "", " \t", "é?", "What? \n", None, "\x1c", "a.b", "."]
    roles = ["user", "assistant", "system", "tool", "", None, "u", "User"]
    return [(conv, draw.choice([None, *range(12)]) if conv % 3 else turn, draw.choice(roles if conv % 2 else roles[:3]), draw.choice(texts)) for conv in range(60) for turn in range(draw.randrange(1, 9))]


def one_order(rows):
    """One row a turn, so that brute force has no ties."""
    return list({row[:2]: row for row in rows}.values())


def test_odd_rows(spark):
    rows = one_order(invented(3)) + [(None, None, None, None), (None, 1, "user", "Hi."), (7, 2**62, "user", "far."), (7, -(2**62), "user", "off.")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"audit": F.lit("clash"), "_kind": F.lit(3), "present": F.lit("clash")})
    expected = [row if row[0] != 7 else (7, 0, *row[2:]) for row in brute(rows)]  # a span beyond 64 bits
    found = [row if row[0] != 7 else (7, 0, *row[2:]) for row in rows_of(audit_conversations(damage(frame)))]
    assert found == expected


def test_repeated_rows_and_lost_conversations(spark):
    rows = [(1, 5, "user", "Twice."), (1, 5, "user", "Twice."), (1, 5, "user", "Twice."), (1, 6, "assistant", "So.")]
    lost = next(conv for conv in range(10**6) if crc(conv, 0) == 0)
    rows += [(lost, 0, "user", "Gone.")]
    assert rows_of(audit_conversations(damage(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)
    assert (lost, 0, 0, 0, 0, 0, 0, "", EMPTY) in brute(rows)
    assert rows_of(audit_conversations(damage(spark.createDataFrame([], SCHEMA)))) == []


def test_one_conversation_holds_most_rows_and_a_text_is_long(spark):
    draw = random.Random(9)
    rows = [(1, turn, draw.choice(["user", "assistant"]), draw.choice(["Yes.", f"Nr {turn}.", f"{turn}", ""])) for turn in range(3000)]
    rows += [(2, 0, "user", "long " * 1_000_000), (2, 1, "assistant", "é" * 300_000 + "!")]
    assert rows_of(audit_conversations(damage(spark.createDataFrame(rows, SCHEMA).repartition(9)))) == brute(rows)


def test_repaired_turns_make_the_digest_and_need_no_repair(spark):
    rows = one_order(invented(5))
    damaged = damage(spark.createDataFrame(rows, SCHEMA))
    groups = {}
    for row in rows_of(repaired_turns(damaged).orderBy("conv_id", "at")):
        groups.setdefault(row[0], []).append(row[1:])
    for conv, *_, sha in rows_of(audit_conversations(damaged)):
        lines = [f"{role}:{text}" for _, role, text in sorted(groups.get(conv, []))]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == sha
