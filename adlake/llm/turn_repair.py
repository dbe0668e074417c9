"""Repairs conversations so that their turns alternate.

Role initials of a sound conversation read ``(s?(ua)+)?``, so the number of
turns that remain fixes the whole sequence of roles: ``ua...`` where it is even,
``sua...`` where it is odd. Turns are aligned to that target for each feasible
length (Wagner and Fischer), within the band of cells that can still cost no
more than the best alignment so far (Ukkonen); alignments of equal cost are
compared by their audits, the letters of their edits in order.

A conversation's turns become one letter each before they are gathered, so a
conversation of many millions of turns is a string of as many bytes. It is
aligned block by block: within a block from each state of the grammar to each
other, and the blocks' costs are then chained. Texts are not gathered: they
stream past in order, once the audit is known, into the repaired digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.shared import add_columns, pieces, quoted

# The edits' costs.
REROLE = 3
DELETE = 4
INSERT = 3
TRUNCATED = 3  # for a truncated turn that stays

BLOCK_TURNS = 32
CACHED_BLOCKS = 200_000
FOREVER = 1 << 60

# Characters that are not white space, and those that end a text.
WRITTEN = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

# States of the grammar: nothing yet, or the last role's initial.
START = "-"
ENDS = (START, "a")


# -- alignment -------------------------------------------------------------


def target(entry: str, length: int, system: bool) -> str:
    """The roles of ``length`` turns after a state, by initials."""
    following = {START: "ua", "s": "ua", "u": "au", "a": "ua"}[entry]
    return (("s" if system else "") + following * (length // 2 + 1))[:length]


def replace_cost(turn: str, role: str) -> int:
    """Keeping or reroling a turn. Its letter is the initial of its role (``o``:
    another), a capital if truncated, and ``x`` where it must go."""
    if turn == "x":
        return FOREVER
    added = TRUNCATED if turn.isupper() else 0
    if turn.lower() == role:
        return added
    return FOREVER if role == "s" else REROLE + added


def _lead(turns: int, roles: int) -> int:
    """The least cost of so many more turns than roles, or fewer."""
    return DELETE * (turns - roles) if turns > roles else INSERT * (roles - turns)


def align(turns: str, roles: str, most: int, final: bool) -> tuple[int, str] | None:
    """The cheapest edits of ``turns`` into ``roles``, the ASCII-least audit
    among equals; None where they cost over ``most``.

    Cells outside the band cannot lie on an alignment of cost ``most``: they are
    too many deletions or insertions away from either end. Unless ``final``, the
    last edit takes a turn: insertions after it belong to the next block.
    """
    n, m = len(turns), len(roles)
    cost = [{} for _ in range(n + 1)]  # cost[i][j]: from turn i and role j to the ends
    for i in range(n, -1, -1):
        row, below = cost[i], cost[i + 1] if i < n else {}
        for j in range(m, -1, -1):
            if _lead(i, j) + _lead(n - i, m - j) > most:
                continue
            if i == n and j == m:
                row[j] = 0
                continue
            best = FOREVER
            if i < n:
                best = below.get(j, FOREVER) + DELETE
                if j < m:
                    best = min(best, below.get(j + 1, FOREVER) + replace_cost(turns[i], roles[j]))
            if j < m and roles[j] != "s" and (i < n or final):
                best = min(best, row.get(j + 1, FOREVER) + INSERT)
            row[j] = best
    total = cost[0].get(0, FOREVER)
    if total > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = cost[i][j]
        if i < n and left == cost[i + 1].get(j, FOREVER) + DELETE:
            audit.append("D")
            i += 1
        elif j < m and roles[j] != "s" and (i < n or final) and left == cost[i].get(j + 1, FOREVER) + INSERT:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == roles[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(audit)


@lru_cache(CACHED_BLOCKS)
def align_block(turns: str, entry: str, final: bool) -> dict[str, tuple[int, str]]:
    """The cheapest (cost, audit) from a state to each state that can follow,
    over all feasible lengths, the likeliest first."""
    best: dict[str, tuple[int, str]] = {}
    n = len(turns)
    most = DELETE * n + INSERT * 3  # all turns deleted, and inserts to any state
    lengths = range(0, n + most // INSERT + 1)
    for length in sorted(lengths, key=lambda length: abs(length - n)):
        for system in (False, True) if entry == START and length else (False,):
            roles = target(entry, length, system)
            state = roles[-1] if roles else entry
            if final and state not in ENDS:
                continue
            limit = best[state][0] if state in best else most
            if _lead(n, length) > limit:
                continue
            found = align(turns, roles, limit, final)
            if found is not None and (state not in best or found < best[state]):
                best[state] = found
    return best


def repair(turns: str) -> tuple[int, str]:
    """The cheapest edits of a whole conversation and their audit."""
    blocks = [turns[at : at + BLOCK_TURNS] for at in range(0, len(turns), BLOCK_TURNS)] or [""]
    last = len(blocks) - 1
    ahead: list[dict[str, int]] = [{} for _ in blocks] + [dict.fromkeys(ENDS, 0)]
    for at in range(last, -1, -1):
        for entry in (START, "s", "u", "a") if at else (START,):
            ways = [cost + ahead[at + 1][state] for state, (cost, _) in align_block(blocks[at], entry, at == last).items() if state in ahead[at + 1]]
            if ways:
                ahead[at][entry] = min(ways)
    state, audits = START, []
    for at, block in enumerate(blocks):
        ways = align_block(block, state, at == last).items()
        cheapest = [(audit, after) for after, (cost, audit) in ways if after in ahead[at + 1] and cost + ahead[at + 1][after] == ahead[at][state]]
        audit, state = min(cheapest)
        audits.append(audit)
    return ahead[0][START], "".join(audits)


# -- damage ----------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` of the rows as they arrive,
    and ``present``: false for a row that is lost, which keeps its conv_id.

    The crc32 of ``conv_id:turn`` decides, a null standing as one blank there,
    in the role and in the text.
    """
    blank = F.lit(" ")
    key = F.concat(*[F.coalesce(c, blank) for c in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    fate = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), fate.alias("_fate")
    )
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_fate") == 3, 2).otherwise(1)
    damaged = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("_fate") != 0).alias("present"), F.sequence(F.lit(1), copies).alias("_copies"))
    return damaged.withColumn("_copies", F.explode("_copies")).drop("_copies")


# -- the table's conversations ---------------------------------------------


def text_hashes() -> list[Column]:
    return [F.xxhash64("text").alias("_h1"), F.xxhash64("text", F.lit(1)).alias("_h2")]


def in_turn() -> list[Column]:
    """The order of turns; rows of one turn by role and then by their text's
    hashes, so that equal rows stand together and every run has one order."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("_h1"), F.col("_h2")]


def turn_letters(rows: DataFrame) -> DataFrame:
    """One row per conversation: its turns as letters, and its faults counted.

    Rows carry hashes in place of texts here. The windows and both groupings
    need the rows of a conversation together, so there is one shuffle; windows
    sort on disk where needed, and no more than ``BLOCK_TURNS`` rows are ever
    gathered as rows.
    """
    light = rows.select(
        "conv_id", "turn", "role", "present", *text_hashes(),
        ~F.col("text").rlike(WRITTEN) & F.col("present"),
        F.col("text").rlike(ENDED),
    ).toDF("conv_id", "turn", "role", "present", "_h1", "_h2", "_blank", "_ended")
    together = light.repartition("conv_id")
    here = Window.partitionBy("conv_id")
    seen = F.row_number().over(here.partitionBy("conv_id", "present", "role", "_h1", "_h2").orderBy(F.col("turn").asc_nulls_first())) > 1
    ordered = here.partitionBy("conv_id", "present").orderBy(*in_turn())
    initial = F.substring("role", 1, 1)
    faults = together.withColumn("_seen", seen & F.col("present")).withColumns(
        {
            "_at": F.row_number().over(ordered),
            "_before": F.lag(initial).over(ordered),
            "_turn_before": F.lag("turn").over(ordered),
        }
    )
    must_go = F.col("_blank") | F.col("_seen")
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    counted = faults.select(
        "conv_id", "present", "turn", "_at",
        F.floor((F.col("_at") - 1) / BLOCK_TURNS).alias("_block"),
        F.when(~F.col("present"), "").when(must_go, "x").when(F.col("_ended"), letter).otherwise(F.upper(letter)).alias("_letter"),
        F.col("_blank").cast("long").alias("blank"),
        (F.col("_seen") & ~F.col("_blank")).cast("long").alias("duplicate"),
        (F.col("present") & ~must_go & ~F.col("_ended")).cast("long").alias("truncated"),
        (F.col("present") & F.col("_before").isNotNull() & ~F.concat("_before", initial).isin("su", "ua", "au")).cast("long").alias("illegal"),
        (F.col("present") & F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn_before"))).cast("long").alias("_turns"),
    )
    kept_turn = F.when(F.col("present"), F.col("turn"))
    sums = ("blank", "duplicate", "truncated", "illegal", "_turns")
    blocks = counted.groupBy("conv_id", "present", "_block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_letter"))), lambda x: x["_letter"]), "").alias("_letters"),
        F.min(kept_turn).alias("_first"), F.max(kept_turn).alias("_last"), *[F.sum(name).alias(name) for name in sums],
    )
    whole = blocks.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("present"), F.struct("_block", "_letters")))), lambda x: x["_letters"]), "").alias("_letters"),
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), *[F.sum(name).alias(name) for name in sums],
    )
    wide = [F.col(name).cast("decimal(38,0)") for name in ("_last", "_first", "_turns")]
    gaps = F.coalesce((wide[0] - wide[1] + 1 - wide[2]).try_cast("long"), F.lit(0))
    return whole.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "_letters")


def plan_repairs(rows: DataFrame) -> DataFrame:
    """``turn_letters`` with the ``cost`` and ``audit`` of the cheapest repair."""

    def start() -> Callable[[list], list]:
        def run(conversations: list[str]) -> list:
            found = [repair(letters) for letters in conversations]
            return [[cost for cost, _ in found], [audit for _, audit in found]]

        return run

    return add_columns(turn_letters(rows), "_letters", {"cost": "long", "audit": "string"}, start).drop("_letters")


def repaired_lines(audit: str) -> Iterator[tuple[str, str | None]]:
    """Each edit with the role it gives, None where the turn keeps its own."""
    length = len(audit) - audit.count("D")
    names = {"s": "system", "u": "user", "a": "assistant"}
    roles = iter(target(START, length, length % 2 == 1))
    for edit in audit:
        role = None if edit == "D" else names[next(roles)]
        yield edit, None if edit in "DK" else role


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


class Rewriter:
    """Takes the turns of one conversation in order and gives its repaired ones."""

    def __init__(self, audit: str):
        self.edits = repaired_lines(audit)

    def _inserted(self) -> Iterator[tuple[str, str]]:
        for edit, role in self.edits:
            if edit != "I":
                self.current = edit, role
                return
            yield role, ""
        self.current = None

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserted()
        edit, new = self.current
        if edit != "D":
            yield new or role, text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


def _in_order(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan and then its rows in order, a conversation in one
    task. This is the only shuffle of texts."""
    turns = rows.where("present").select("conv_id", F.lit(1).alias("_kind"), "turn", "role", "text", *text_hashes())
    heads = plans.select("conv_id", F.lit(0).alias("_kind"), *RESULT)
    both = heads.unionByName(turns, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "_kind", *in_turn()).drop("_h1", "_h2")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id``, ``at`` (from 0), ``role`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ats, roles, texts = [], [], [], []
        conv = writer = None
        at = 0

        def emit(lines: Iterator[tuple[str, str]]) -> None:
            nonlocal at
            for role, text in lines:
                ids.append(conv)
                ats.append(at)
                roles.append(role)
                texts.append(text)
                at += 1

        def taken() -> pa.RecordBatch:
            arrays = [pa.array(ids, pa.int64()), pa.array(ats, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())]
            for values in (ids, ats, roles, texts):
                values.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "at", "role", "text"])

        for batch in pieces(batches):
            for row in batch.to_pylist():
                if row["_kind"] == 0:
                    if writer is not None:
                        emit(writer.end())
                    conv, at, writer = row["conv_id"], 0, Rewriter(row["audit"])
                else:
                    emit(writer.turn(row["role"], row["text"]))
            yield taken()
        if writer is not None:
            emit(writer.end())
            yield taken()

    ordered = _in_order(rows, plan_repairs(rows)).select(F.col("conv_id").cast("long").alias("conv_id"), "_kind", "role", "text", "audit")
    return ordered.mapInArrow(run, "conv_id long, at long, role string, text string")


def audit_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conv_id``, ``turn``, ``role``, ``text`` and
    ``present`` rows: its faults, the cheapest repair and the digest of the
    repaired ``role:text`` lines.

    A null conv_id is a conversation like any other. Turns are ordered with
    nulls first and, within a turn, by role and text hash. A text without a
    character that is not white space is blank; role and text seen earlier in the
    conversation make a duplicate; a last such character other than ``.!?`` makes
    it truncated. A conversation without rows that are present has zeros, an
    empty audit and the digest of nothing; a table without rows gives none. Other
    columns play no part. Equal texts are told by two 64-bit hashes.
    """
    ordered = _in_order(rows, plan_repairs(rows)).drop("turn")
    conv_type = dict(rows.dtypes)["conv_id"]
    names = ["conv_id", *RESULT, "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        head = writer = digest = None
        first = True

        def feed(lines: Iterator[tuple[str, str]]) -> None:
            nonlocal first
            for role, text in lines:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False

        def close() -> None:
            if head is not None:
                feed(writer.end())
                out.append(head | {"repaired_sha256": digest.hexdigest()})

        def taken(schema: pa.Schema) -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, pa.schema([*[schema.field(name) for name in names[:-1]], pa.field(names[-1], pa.string())]))
            out.clear()
            return made

        schema = None
        for batch in pieces(batches):
            schema = batch.schema
            for row in batch.to_pylist():
                if row["_kind"] == 0:
                    close()
                    head = {name: row[name] for name in names[:-1]}
                    writer, digest, first = Rewriter(row["audit"]), hashlib.sha256(), True
                else:
                    feed(writer.turn(row["role"], row["text"]))
            if out:
                yield taken(schema)
        close()
        if out:
            yield taken(schema)

    kinds = dict(ordered.dtypes)
    schema = [f"{quoted('conv_id')} {conv_type}", *[f"{name} {kinds[name]}" for name in RESULT], "repaired_sha256 string"]
    return ordered.mapInArrow(run, ", ".join(schema))
