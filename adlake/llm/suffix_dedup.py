"""Removes every byte covered by a 100-byte string that occurred before.

Suffixes are sorted by induction. A sample of anchor suffixes is sorted first:
in every 100-byte window the 20-byte string of least hash is the window's
anchor, so equal windows have equal anchors in equal places. The order of all
other suffixes follows from that of the anchors byte by byte to the left: a
suffix is the tuple (its first byte, the rank of the suffix after it), and its
common prefix with its neighbour is one more than the least common prefix
between the two suffixes they come from. Suffixes with a common prefix of at
least 100 bytes start with the same string.

Spark's external sort, which spills to disk, is the queue: it deals the anchor
suffixes to tasks by anchor and hands them over in order, in blocks of whole
anchors, so a task's memory has a bound whatever the size of its shard. A
window has one anchor, so no recursion into shorter strings is needed. Anchors
that stand alone in the corpus are dropped before any text is moved, and copies
of a text before all else. Anchors of very many suffixes would not fit a block;
their windows are counted by hash instead, pre-aggregated in each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.shared import chunks, few, mix64, row_key, stored, substring_hashes, utf8

LENGTH = 100  # bytes of a string that counts
ANCHOR = 20
SPAN = LENGTH - ANCHOR + 1  # places of an anchor in a window
BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 30_000  # anchor suffixes sorted at once
MOST_SUFFIXES = 65_536  # of an anchor that are sorted together: some 30 MB
LOCAL = 4  # times in a batch from which an anchor's rows need no grouping
SPREAD = 1 << 20


def window_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of some texts.

    One row for each run of windows with the same anchor: number of the text,
    place of the anchor in it, its hash, and the runs' first window; runs are
    in order, and the windows of a run are consecutive.
    """
    sizes = np.array([len(text) for text in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(flat) < LENGTH:
        return none, none, none.astype(np.uint64), none
    at = np.arange(len(flat) - ANCHOR + 1)
    hashes = mix64(substring_hashes(flat, at, at + ANCHOR))
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    least = sliding_least(keys, SPAN)
    ends = np.repeat(np.cumsum(sizes), sizes)
    starts = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends[: len(least)])
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else none
    owner = np.repeat(np.arange(len(texts)), sizes)[anchor[first]]
    begin = (np.cumsum(sizes) - sizes)[owner]
    return owner, anchor[first] - begin, hashes[anchor[first]], starts[first] - begin


def sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` consecutive values, by least values within blocks."""
    count = len(values) - span + 1
    padded = np.concatenate([values, np.full(-len(values) % span, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, span)
    up = np.minimum.accumulate(padded, axis=1).ravel()
    down = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:count], up[span - 1 : span - 1 + count])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors and their places. Where a batch has an anchor often, its rows are
    known to repeat and are dealt anywhere (``deal`` above 0); one mark (place
    -1) tells the task that gathers the anchor's other rows."""
    for batch in batches:
        hashes, texts = batch.column("_hash").to_numpy(), [utf8(text) for text in batch.column("text").to_pylist()]
        found = [(part, *window_anchors(texts[part])[:3]) for part in chunks(map(len, texts), BLOCK_BYTES)]
        if not found:
            continue
        anchor = np.concatenate([mark for _, _, _, mark in found]).view(np.int64)
        place = np.concatenate([at for _, _, at, _ in found]).astype(np.int32)
        text = np.concatenate([hashes[part][owner] for part, owner, _, _ in found])
        values, inverse, counts = np.unique(anchor, return_inverse=True, return_counts=True)
        often = counts >= LOCAL
        deal = np.where(often[inverse], 1 + np.arange(len(anchor)) % SPREAD, 0).astype(np.int32)
        marks = values[often]
        none = np.zeros(len(marks), np.int64)
        columns = [np.append(anchor, marks), np.append(deal, none.astype(np.int32)), np.append(text, none), np.append(place, none.astype(np.int32) - 1)]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["anchor", "deal", "_hash", "place"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of anchors that occur more than once; rows come sorted by anchor."""
    held: pa.RecordBatch | None = None  # the last row, while its anchor has one only
    last = None  # the anchor of the rows before
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column("anchor").to_numpy()
        same = anchor[1:] == anchor[:-1]
        several = np.append(anchor[0] == last if last is not None else False, same)
        if held is not None and several[0]:
            yield held.drop_columns(["deal"])
        several[:-1] |= same
        repeats = several & (batch.column("place").to_numpy() >= 0) | (batch.column("deal").to_numpy() > 0)
        yield batch.filter(pa.array(repeats)).drop_columns(["deal"])
        told = several[-1] or batch.column("place")[-1].as_py() < 0 or batch.column("deal")[-1].as_py() > 0
        held, last = None if told else batch.slice(batch.num_rows - 1), anchor[-1]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each wanted anchor of a text its bytes to the left and to the right."""
    for batch in batches:
        texts = [utf8(text) for text in batch.column("text").to_pylist()]
        places, frequent = batch.column("places").to_pylist(), batch.column("frequent").to_pylist()
        ids, hashes = batch.column("_id").to_numpy(), batch.column("_hash").to_numpy()
        for part in chunks(map(len, texts), BLOCK_BYTES):
            own = texts[part]
            owner, place, anchor, first = window_anchors(own)
            # A run of windows ends before the next run of its text begins.
            after = np.append(first[1:], 0)
            ends = np.array([len(text) - LENGTH for text in own])
            last = np.where(np.append(owner[1:], -1) == owner, after - 1, ends[owner])
            columns: list[list] = [[] for _ in range(7)]
            wanted = [dict(zip(places[part][at], frequent[part][at])) for at in range(len(own))]
            for text, at, mark, low, high in zip(owner.tolist(), place.tolist(), anchor.view(np.int64).tolist(), first.tolist(), last.tolist()):
                flag = wanted[text].get(at)
                if flag is None:
                    continue
                row = (mark, own[text][low:at], own[text][at : high + LENGTH], int(ids[part][text]), int(hashes[part][text]), at, flag)
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "left", "right", "_id", "_hash", "place", "frequent"])


def _padded(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(value) for value in values], np.int64)
    flat = np.frombuffer(b"".join(value.ljust(width, b"\0") for value in values), np.uint8)
    return flat.reshape(len(values), width), sizes


def repeated_windows(group: np.ndarray, left: list[bytes], right: list[bytes], rank: np.ndarray) -> np.ndarray:
    """Which windows occurred before: anchor suffixes by bytes to their left.

    Suffixes are sorted by group and by ``right``. ``rank`` is the order of
    their places in the corpus.
    """
    count = len(group)
    after, room = _padded(right, LENGTH)
    before, reach = _padded([value[::-1] for value in left], SPAN)
    found = np.zeros((count, SPAN), bool)
    # Common prefix of each suffix with the one sorted before it.
    differ = np.ones((count, LENGTH + 1), bool)
    differ[1:, :LENGTH] = after[1:] != after[:-1]
    common = np.minimum(differ.argmax(axis=1), np.minimum(room, np.roll(room, 1)))
    common[0] = 0
    common[np.flatnonzero(group[1:] != group[:-1]) + 1] = 0
    order = np.arange(count)
    for offset in range(SPAN):
        if offset:
            stays = reach[order] >= offset
            # The byte before, then the rank of what follows: a stable sort.
            key = np.where(stays, group[order] * 256 + before[order, offset - 1], -1)
            place = np.argsort(key, kind="stable")[np.count_nonzero(~stays) :]
            if len(place) < 2:
                break
            key = key[place]
            joined = np.append(False, key[1:] == key[:-1])
            ranges = np.stack([place[:-1] + 1, place[1:] + 1], axis=1)[joined[1:]]
            new = np.zeros(len(place), np.int64)
            if len(ranges):
                # Least common prefix between the two places; one spare value ends the last range.
                least = np.minimum.reduceat(np.append(common, 0), ranges.ravel())[::2]
                new[joined] = least + 1
            order, common = order[place], new
        alike = common >= LENGTH
        if alike.any():
            number = np.cumsum(~alike) - 1
            starts = np.flatnonzero(~alike)
            first = np.minimum.reduceat(rank[order], starts)[number]
            found[order, offset] = rank[order] > first
    return found


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges covered by repeated windows, from sorted anchor suffixes."""
    held: list[pa.RecordBatch] = []
    size = 0

    def ranges(table: pa.Table) -> pa.RecordBatch:
        anchor, ids, hashes, place = (table[name].to_numpy() for name in ("anchor", "_id", "_hash", "place"))
        group = np.cumsum(np.append(0, anchor[1:] != anchor[:-1]))
        rank = np.empty(len(group), np.int64)
        rank[np.lexsort((place, hashes, ids))] = np.arange(len(group))
        found = repeated_windows(group, table["left"].to_pylist(), table["right"].to_pylist(), rank)
        edges = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edges == 1)
        _, high = np.nonzero(edges == -1)  # offsets low to high - 1 are a run
        return pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(hashes[row]), pa.array(place[row] - high + 1), pa.array(place[row] - low + LENGTH)], ["_id", "_hash", "start", "end"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < BLOCK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        anchor = table["anchor"].to_numpy()
        cut = int(np.searchsorted(anchor, anchor[-1]))
        if cut:
            yield ranges(table.slice(0, cut))
            held, size = table.slice(cut).to_batches(), len(anchor) - cut
    if size:
        yield ranges(pa.Table.from_batches(held))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of each window of some anchor suffixes, and its place."""
    for batch in batches:
        texts = [a + b for a, b in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())]
        begins = batch.column("place").to_numpy() - np.array([len(x) for x in batch.column("left").to_pylist()], np.int64)
        sizes = np.array([len(text) for text in texts], np.int64)
        counts = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(texts)), counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        at = (np.cumsum(sizes) - sizes)[owner] + inside
        half = substring_hashes(flat, at, at + LENGTH // 2), substring_hashes(flat, at + LENGTH // 2, at + LENGTH)
        first, second = mix64(half[0]) ^ half[1], mix64(half[1]) + half[0]
        ids, hashes = batch.column("_id").to_numpy(), batch.column("_hash").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(mix64(first).view(np.int64)), pa.array(mix64(second).view(np.int64)), pa.array(ids[owner]), pa.array(hashes[owner]), pa.array(begins[owner] + inside)],
            ["h1", "h2", "_id", "_hash", "start"],
        )


def _counted(suffixes: DataFrame) -> DataFrame:
    """Ranges of repeated windows of frequent anchors, by the windows' hashes."""
    windows = suffixes.select("left", "right", "_id", "_hash", "place").mapInArrow(_windows, "h1 long, h2 long, _id long, _hash long, start long")
    place = F.struct("_id", "_hash", "start")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last")
    later = windows.join(stored(first.drop("last"), "windows"), ["h1", "h2"]).where(place > F.col("first"))
    return later.select("_id", "_hash", "start", (F.col("start") + LENGTH).alias("end"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def repeated_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Byte ranges (_id, _hash, start, end) that repeat, and later copies of texts.

    ``docs`` has _id, _hash and text; of each text one row of the least _id
    alone is looked at, so a row that repeats is no earlier copy of itself.
    """
    long = docs.where(F.octet_length("text") >= LENGTH)
    both = [F.col("_hash"), F.xxhash64(F.lit(1), "text").alias("_other")]
    keys = long.select("_id", *both)
    groups = keys.groupBy("_hash", "_other").agg(F.min("_id").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    groups = stored(groups.drop("rows"), "copied")
    copied = keys.join(few(groups), ["_hash", "_other"])
    copies = stored(copied.where(F.col("_id") > F.col("least")).select("_id", "_hash").distinct(), "copies")
    alone = long.join(few(copies), ["_id", "_hash"], "left_anti")
    first = copied.where(F.col("_id") == F.col("least")).groupBy("_id", "_hash").count()
    repeated = stored(first.where(F.col("count") > 1).select("_id", "_hash"), "repeated")
    if repeated.limit(1).count():
        once = stored(alone.join(few(repeated), ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]), "once")
        alone = alone.join(few(repeated), ["_id", "_hash"], "left_anti").unionByName(once)

    anchors = alone.select("_hash", "text").mapInArrow(_anchors, "anchor long, deal int, _hash long, place int")
    dealt = anchors.repartition("anchor", "deal").sortWithinPartitions("anchor", "deal")
    several = dealt.mapInArrow(_repeated, "anchor long, _hash long, place int")
    several = stored(several, "anchors")
    frequent = stored(several.groupBy("anchor").count().where(F.col("count") > MOST_SUFFIXES).select("anchor", F.lit(True).alias("frequent")), "frequent")
    marked = several.join(few(frequent), "anchor", "left").withColumn("frequent", F.coalesce("frequent", F.lit(False)))
    wanted = stored(marked.groupBy("_hash").agg(F.collect_list("place").alias("places"), F.collect_list("frequent").alias("frequent")), "wanted")
    texts = alone.join(few(wanted.select("_hash")), "_hash", "left_semi").join(wanted, "_hash")
    kind = "anchor long, left binary, right binary, _id long, _hash long, place int, frequent boolean"
    suffixes = texts.select("_id", "_hash", "text", "places", "frequent").mapInArrow(_suffixes, kind)
    suffixes = stored(suffixes, "suffixes")
    sorted_ = suffixes.where("NOT frequent").drop("frequent").repartition("anchor").sortWithinPartitions("anchor", "right")
    ranges = sorted_.mapInArrow(_induce, "_id long, _hash long, start long, end long")
    if frequent.limit(1).count():
        ranges = ranges.unionByName(_counted(suffixes.where("frequent")))
    return ranges, copies


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """Per document what is left without bytes that repeat.

    A byte goes if a 100-byte string that covers it also starts earlier: in a
    document of smaller doc_id, or earlier in its own; overlaps count, and
    strings are judged on the input. Returns doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs), kept_sha256 and kept (the remaining bytes).

    A null text is empty; texts under 100 bytes have no such string. Rows that
    repeat doc_id and text are one document and get the same result; a null
    doc_id comes before all others, and rows of one doc_id with different texts
    are in order of a hash of the text. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.select("doc_id", "text", *row_key())
    ranges, copies = repeated_ranges(keyed)
    held = stored(ranges.groupBy("_id", "_hash").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "ranges")
    bytes_ = F.octet_length("text").cast("long")
    out = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    touched = few(held.select("_id", "_hash", F.lit(True).alias("touched")))
    copied = few(copies.withColumn("copied", F.lit(True)))
    marked = keyed.join(copied, ["_id", "_hash"], "left").join(touched, ["_id", "_hash"], "left")
    gone = F.coalesce("copied", F.lit(False))
    plain = marked.where(F.col("touched").isNull()).select(
        "doc_id", bytes_.alias("n_bytes"), F.when(gone, bytes_).otherwise(0).alias("n_removed"), gone.cast("long").alias("n_spans"),
        F.sha2(F.when(gone, F.lit("")).otherwise(F.col("text")).cast("binary"), 256).alias("kept_sha256"),
        F.when(gone, F.lit("")).otherwise(F.col("text")).cast("binary").alias("kept"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in out[1:]]
            for text, found in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                whole, spans = utf8(text), merged([(r["start"], r["end"]) for r in found])
                edges = [0, *[edge for span in spans for edge in span], len(whole)]
                kept = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
                row = (len(whole), len(whole) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], out)

    changed = marked.where(F.col("touched")).select("doc_id", "text", "_id", "_hash").join(held, ["_id", "_hash"]).select("doc_id", "text", "ranges")
    changed = changed.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return plain.select(*out).unionByName(changed)
