"""Balanced label propagation: linked documents move to one shard, sizes stay even."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.shared import few, stored

ROWS_IN_BUCKET = 20_000


def ranked(frame: DataFrame, within: list[str], order: list[str], spread: list[str], rank: str) -> DataFrame:
    """Gapless numbers from 0 within groups of any size, by ``order`` columns.

    ``order`` must have few values (a class, not an id). Rows are dealt to
    buckets by a hash of ``spread``; each bucket is numbered by itself and
    starts after the buckets before it, so no task gets a whole group.
    """
    buckets = max(1, frame.count() // ROWS_IN_BUCKET)
    dealt = frame.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int"))
    keys = [*within, *order, "_bucket"]
    counts = dealt.groupBy(*keys).agg(F.count("*").alias("_count"))
    before = Window.partitionBy(*within).orderBy(*order, "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*spread)
    numbered = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    return numbered.join(starts, keys).withColumn(rank, F.col("_start") + F.col("_inside")).drop("_bucket", "_start", "_inside")


def moves_allowed(wanted: dict[tuple[int, int], int], counts: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wanted moves between shards may happen.

    First what is met by moves the other way, then what the capacity allows.
    The table is shards by shards, whatever the data.
    """
    shards = range(len(counts))
    allowed = {(i, j): min(n, wanted.get((j, i), 0)) for (i, j), n in wanted.items()}
    left = {pair: n - allowed[pair] for pair, n in wanted.items() if n > allowed[pair]}
    now = list(counts)
    for i in sorted(shards, key=lambda i: capacity[i] - now[i]):  # from the fullest
        for j in sorted(shards, key=lambda j: now[j] - capacity[j]):  # to the emptiest
            n = min(left.get((i, j), 0), max(0, capacity[j] - now[j]))
            if n:
                allowed[i, j] += n
                now[i], now[j] = now[i] - n, now[j] + n
    return {pair: n for pair, n in allowed.items() if n}


def _pairs(frame: DataFrame, start: str, end: str) -> dict[tuple[int, int], int]:
    return {(row[start], row[end]): row["n"] for row in frame.groupBy(start, end).agg(F.count("*").alias("n")).collect()}


def _counts(state: DataFrame, shards: int) -> list[int]:
    found = {row["shard"]: row["count"] for row in state.groupBy("shard").count().collect()}
    return [found.get(shard, 0) for shard in range(shards)]


def _move(state: DataFrame, wishes: DataFrame, allowed: dict[tuple[int, int], int]) -> DataFrame:
    """Moves the first so many of each (shard, target); ``wishes`` has a class ``order``."""
    quota = F.create_map(*[F.lit(x) for (i, j), n in allowed.items() for x in (f"{i} {j}", n)]) if allowed else None
    if quota is None:
        return state
    placed = ranked(wishes, ["shard", "target"], ["order"], ["row", "group"], "place")
    goes = F.col("place") < F.coalesce(quota[F.concat_ws(" ", "shard", "target")], F.lit(0))
    moved = placed.where(goes).select("row", F.col("target").alias("to"))
    return state.join(moved, "row", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")


def balanced_labels(members: DataFrame, shards: int, rounds: int = 6) -> DataFrame:
    """Puts rows into shards of sizes at most one apart, cutting few links.

    ``members`` has ``row`` (unique) and ``group`` (null: no links); the rows of
    a group are linked with each other. Links are counted through the group, as
    a histogram over the shards, never as pairs. Each round a row wants to go
    where most rows of its group are; quotas between shards let as many move as
    a shard's size allows. The last step moves rows, those without links first,
    until sizes are equal.
    """
    state = members.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(shards)).cast("int"))
    linked = stored(members.where(F.col("group").isNotNull()).groupBy("group").count().where("count > 1").select("group", F.lit(True).alias("linked")), "groups")
    state = stored(state.join(few(linked), "group", "left").select("row", "group", F.coalesce("linked", F.lit(False)).alias("linked"), "shard"), "labels")
    total = sum(_counts(state, shards))
    capacity = [total // shards + (shard < total % shards) for shard in range(shards)]
    # Rows without links fit anywhere and make room in the last step, so the
    # quotas count the others alone.
    ties = state.where("linked").drop("linked")
    counts = _counts(ties, shards)
    alone = state.where("NOT linked").select("row", "group", "shard", "linked")
    for number in range(rounds):
        histogram = ties.groupBy("group", "shard").agg(F.count("*").alias("here"))
        # Equal counts: a shard that depends on group and round, else all crowd into one.
        tie = -F.pmod(F.xxhash64("group", "shard", F.lit(number)), F.lit(1 << 30))
        # A full shard is no target: a group larger than a shard goes on to the next.
        full = [shard for shard in range(shards) if counts[shard] >= capacity[shard]]
        choice = F.when(~F.col("shard").isin(full), F.struct("here", tie.alias("tie"), F.col("shard").alias("target")))
        best = F.max(choice).over(Window.partitionBy("group"))
        wanted = histogram.withColumn("best", best).where((F.col("best.target") != F.col("shard")) & (F.col("best.here") >= F.col("here")))
        wanted = stored(wanted.select("group", "shard", "best.target", (F.col("best.here") - F.col("here")).alias("gain")), "targets")
        wishes = ties.join(few(wanted), ["group", "shard"]).withColumn("order", -F.least("gain", F.lit(16)))
        wishes = stored(wishes.select("row", "group", "shard", "target", "order"), "wishes")
        allowed = moves_allowed(_pairs(wishes, "shard", "target"), counts, capacity)
        if not allowed:
            break
        for (start, end), n in allowed.items():
            counts[start], counts[end] = counts[start] - n, counts[end] + n
        ties = stored(_move(ties, wishes, allowed), "labels")
    return _even_out(alone.unionByName(ties.withColumn("linked", F.lit(True))), shards, capacity)


def _even_out(state: DataFrame, shards: int, capacity: list[int]) -> DataFrame:
    """Surplus rows, those without links first, fill the shards that lack some."""
    counts = _counts(state, shards)
    surplus = {shard: counts[shard] - capacity[shard] for shard in range(shards) if counts[shard] > capacity[shard]}
    if not surplus:
        return state
    room = [(shard, capacity[shard] - counts[shard]) for shard in range(shards) if counts[shard] < capacity[shard]]
    placed = ranked(state.withColumn("order", F.col("linked").cast("int")), ["shard"], ["order"], ["row", "group"], "place")
    leaves, target, first, start = F.lit(None).cast("int"), F.lit(None).cast("int"), 0, 0
    for shard, n in surplus.items():
        here = F.col("shard") == shard
        leaves = F.when(here & (F.col("place") < n), (F.col("place") + first).cast("int")).otherwise(leaves)
        first += n
    placed = placed.withColumn("leaves", leaves)
    for shard, n in room:
        target = F.when((F.col("leaves") >= start) & (F.col("leaves") < start + n), F.lit(shard)).otherwise(target)
        start += n
    return placed.withColumn("shard", F.coalesce(target, "shard")).drop("place", "order", "leaves")


def shard_documents(docs: DataFrame, shards: int = 8, group: Column | None = None) -> DataFrame:
    """Puts every document into a shard; equal texts are the links.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; null: none),
    text_crc32, law ``rows`` (counts differ by one at most), shard, slot
    (gapless from 0 within a shard) and a null grown_shard. ``group`` overrides
    the links by another key. A group larger than a shard is cut, and only as
    far as sizes require. A null text has size 1 and the checksum of no bytes;
    null texts are linked with nothing, nor with the empty text. Repeated rows
    are rows of their own; null ids and other columns change nothing. An empty
    table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.when(F.col("text").isNotNull(), F.concat_ws(" ", F.xxhash64("text"), F.crc32(text), F.length(text))) if group is None else group.cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("group"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
    labels = balanced_labels(rows.select("row", "group"), shards)
    slots = ranked(labels.select("row", "group", "shard", F.lit(0).alias("order")), ["shard"], ["order"], ["row", "group"], "slot")
    return rows.join(slots.select("row", "shard", "slot"), "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
