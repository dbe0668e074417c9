"""Exact Jaccard join of documents on word shingles, and its components.

A set's shingles are hashes in a fixed order. Two sets that link share one of
their first quarter (the prefix), so sets meet in the groups of their prefix
tokens, sorted by size. Frequent tokens come last in the order, which keeps them
out of most prefixes. Where sets crowd in a group all the same, they meet again
in a second round, dealt to tiles: a token, a band of sizes, and a part of the sets on either side. Parity
bitmaps of 2,048 bits bound the overlap of a pair from above before the sorted
arrays are intersected.

Sets that are already in one component need no further comparison: they are
linked whatever it says. So first the likeliest pair of each set is checked, and
later pairs only between components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.components import components
from adlake.llm.shared import chunks, few, mix64, pieces, stored, substring_hashes, utf8

WORDS = 5
# Similarity of at least 3/4: the overlap is at least 3/7 of both sizes.
BITS = 2048  # of a parity bitmap at least
MOST_BITS = 65_536
FREQUENT = 8  # sets of a token: from there on it comes last in the order
LOCAL_TOKENS = 500_000  # of a task, counted together
COUNTED = 0.35  # of a set
GROUP = 16  # sets of a token that meet at once; more wait for the second round
GROUP_ROWS = 50_000  # of tokens' groups looked at together
MOST_HOT = 1 << 20  # tokens of an order that are broadcast (16 MB)
TILE = 2048
TILE_ROWS = 20_000  # of tiles looked at together, one tile at least
BLOCK_BYTES = 1 << 20
SEEN_SETS = 200_000
PLACE = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, in blocks that end with a word."""
    if len(flat) <= 2 * BLOCK_BYTES:
        return mix64(substring_hashes(flat, starts, ends))
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + BLOCK_BYTES)))
        part = slice(first, last)
        out[part] = substring_hashes(flat[low : ends[last - 1]], starts[part] - low, ends[part] - low)
        first = last
    return mix64(out)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the five-word shingles of each whole text.

    A to Z in lower case; words are what stands between blanks and the
    characters U+0009 to U+000D. Fewer than five words are one shingle.
    """
    for part in chunks([len(text or "") for text in texts], BLOCK_BYTES):
        yield from _shingle_sets([utf8(text).lower() for text in texts[part]])


def _shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    flat = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    word = np.zeros(len(flat) + 2, bool)
    word[1:-1] = ~SPACE[flat]
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    borders = np.cumsum([0, *(len(text) + 1 for text in texts)])
    bounds = np.searchsorted(starts, borders)  # each text's first word, and the end
    words = _word_hashes(flat, starts, ends)
    total = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for at in range(WORDS):
        total += words[at : at + len(total)] * PLACE[at]
    hashes = mix64(total)
    sets = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low >= WORDS:
            own = np.sort(hashes[low : high - WORDS + 1])
            same = own[1:] == own[:-1]
            sets.append(own[np.append(True, ~same)] if same.any() else own)
        elif high > low:
            few_words = (words[low:high] * PLACE[: high - low]).sum(dtype=np.uint64) + np.uint64(high - low)
            sets.append(mix64(np.array([few_words])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def shingle_set(text: str | None) -> np.ndarray:
    return next(shingle_sets([text]))


def set_id(shingles: np.ndarray) -> int:
    """A hash of the set, as a signed 64-bit number."""
    total = mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix64(np.array([total])).view(np.int64)[0])


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """Bit b: whether an odd number of shingles falls on b.

    Bits in which two bitmaps differ are at most the shingles they don't share.
    A larger set has more bits, by powers of two; halves fold by exclusive or.
    """
    bits = min(MOST_BITS, max(BITS, 1 << max(0, len(shingles) - 1).bit_length()))
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1).tobytes()


def folded(bitmaps: list[bytes], bits: int) -> np.ndarray:
    """The bitmaps as rows of 64-bit words, folded to so many bits."""
    out = np.empty((len(bitmaps), bits // 64), np.uint64)
    sizes = np.array([len(bitmap) for bitmap in bitmaps])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        own = np.frombuffer(b"".join([bitmaps[row] for row in rows]), np.uint64)
        out[rows] = np.bitwise_xor.reduce(own.reshape(len(rows), -1, bits // 64), axis=1)
    return out


def may_link(bitmaps_a: np.ndarray, bitmaps_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """False where the bitmaps show that two sets share too little."""
    differ = np.bitwise_count(bitmaps_a ^ bitmaps_b).sum(axis=1, dtype=np.int64)
    return 7 * differ <= sizes_a + sizes_b


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar: intersection against union."""
    if not len(a) or not len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int(np.count_nonzero(b[at] == a))
    return 100 * shared >= 75 * (len(a) + len(b) - shared)


def prefix_size(n: np.ndarray | int) -> np.ndarray | int:
    return n - (3 * n + 3) // 4 + 1


class _Seen:
    """Sets met before in a task; forgets when full."""

    def __init__(self):
        self.ids: set[int] = set()

    def new(self, sid: int) -> bool:
        if sid in self.ids:
            return False
        if len(self.ids) >= SEEN_SETS:
            self.ids.clear()
        self.ids.add(sid)
        return True


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, sid (0 for the empty set) and bitmap of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            if not batch.num_rows:
                continue
            rows = [(len(s), set_id(s) if len(s) else 0, parity_bitmap(s)) for s in shingle_sets(batch.column("text").to_pylist())]
            columns = [pa.array(own, kind) for own, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *columns], ["doc_id", "text_hash", "n_shingles", "sid", "bitmap"])

    schema = "doc_id long, text_hash long, n_shingles long, sid long, bitmap binary"
    return _keyed(docs).mapInArrow(run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of it: rows of one doc_id may have several texts."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _frequent_tokens(docs: DataFrame) -> DataFrame:
    """Tokens of at least ``FREQUENT`` sets, and of how many: token, times.

    Counts the first ``COUNTED`` of each set by hash: a prefix is a quarter, and
    reaches so far when its frequent tokens are put last. They only tell which
    tokens to put last; any choice gives the same links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, size = _Seen(), [], 0

        def told() -> pa.RecordBatch:
            tokens, times = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(times.astype(np.int64))], ["token", "times"])

        for batch in pieces(batches):
            for shingles in shingle_sets(batch.column("text").to_pylist()):
                if len(shingles) and seen.new(set_id(shingles)):
                    parts.append(shingles[: int(len(shingles) * COUNTED) + 1])
                    size += len(parts[-1])
                    if size >= LOCAL_TOKENS:
                        yield told()
                        parts, size = [], 0
        if parts:
            yield told()

    tokens = docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(run, "token long, times long")
    return tokens.groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= FREQUENT)


class Order:
    """Tokens in the order of their hashes, but frequent ones last."""

    def __init__(self, tokens: np.ndarray, times: np.ndarray):
        self.tokens, first = np.unique(tokens.view(np.uint64), return_index=True)
        self.times = times[first]

    def with_first(self, other: Order) -> Order:
        """Both lists, with the other's times where they share a token."""
        return Order(np.append(other.tokens, self.tokens), np.append(other.times, self.times))

    def rank(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(shingles), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, shingles), len(self.tokens) - 1)
        return np.where(self.tokens[at] == shingles, self.times[at], 0)

    def prefix(self, shingles: np.ndarray) -> np.ndarray:
        rank, size = self.rank(shingles), prefix_size(len(shingles))
        plain = shingles[rank == 0]
        if len(plain) >= size:
            return plain[:size]
        return shingles[np.lexsort((shingles, rank))][:size]


def _tokens(docs: DataFrame, orders, every: bool = False) -> DataFrame:
    """Prefix tokens: token, sid, n, place in the set's order.

    ``orders`` is a broadcast of the order, or for the second round of the
    order before, the crowded tokens and the new order: then only sets with a
    crowded token in their prefix before (or ``every`` set) emit. A copy of a
    set met before in the task emits nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = orders.value, _Seen()
        first, crowded, order = order if isinstance(order, tuple) else (None, None, order)
        for batch in pieces(batches):
            parts: list[tuple[np.ndarray, int, int]] = []
            size = 0
            for shingles in shingle_sets(batch.column("text").to_pylist()):
                if not len(shingles):
                    continue
                sid = set_id(shingles)
                if not seen.new(sid) or (first and not every and not crowded.rank(first.prefix(shingles)).any()):
                    continue
                prefix = order.prefix(shingles)
                parts.append((prefix, sid, len(shingles)))
                size += len(prefix)
                if size > 200_000:
                    yield _token_batch(parts)
                    parts, size = [], 0
            if parts:
                yield _token_batch(parts)

    return docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(run, "token long, sid long, n int, place int")


def _token_batch(parts: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
    sizes = [len(tokens) for tokens, _, _ in parts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([tokens for tokens, _, _ in parts]).view(np.int64)),
            pa.array(np.repeat(np.array([sid for _, sid, _ in parts], np.int64), sizes)),
            pa.array(np.repeat(np.array([n for _, _, n in parts], np.int32), sizes)),
            pa.array(np.concatenate([np.arange(size, dtype=np.int32) for size in sizes])),
        ],
        ["token", "sid", "n", "place"],
    )


def group_pairs(token, n, place, most: int | None = None, differ=None):
    """Index pairs (i, j) of rows of one group that may link, group by group.

    Rows are sorted by token and size. Sizes and places bound the overlap from
    above, counting the token as the first one shared; each linked pair passes
    at the token that is. Groups of over ``most`` rows give neighbours only.
    """
    count = len(token)
    ends = np.flatnonzero(np.append(token[1:] != token[:-1], True)) + 1
    sizes = np.diff(np.concatenate([[0], ends]))
    last = np.repeat(ends, sizes)  # the end of each row's group
    left, step = np.flatnonzero(np.arange(count) + 1 < last), 1
    n, place = n.astype(np.int64), place.astype(np.int64)
    large = np.repeat(sizes > most, sizes) if most else np.zeros(count, bool)
    while len(left):
        right = left + step
        fits = 4 * n[left] >= 3 * n[right]  # and so for all smaller steps
        left, right = left[fits], right[fits]
        room = 1 + np.minimum(n[left] - place[left], n[right] - place[right]) - 1
        good = (7 * room >= 3 * (n[left] + n[right])) | (large[left] & (step == 1))
        if differ is not None:
            good &= differ[left] != differ[right]
        yield left[good], right[good]
        step += 1
        left = left[(left + step < last[left]) & ~large[left]]


class _Pairs:
    """Distinct pairs of sets of one block, held as one number each: the places
    of both in the block's list of sets."""

    def __init__(self, sid: np.ndarray):
        self.sids, self.place = np.unique(sid, return_inverse=True)
        self.keys: list[np.ndarray] = []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        ends = self.place[left], self.place[right]
        self.keys.append(np.unique(np.minimum(*ends) * len(self.sids) + np.maximum(*ends)))

    def batch(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.unique(np.concatenate(self.keys)) if self.keys else np.zeros(0, np.int64)
        low, high = np.divmod(keys, max(1, len(self.sids)))
        return self.sids[low], self.sids[high]


def _blocks(batches: Iterator[pa.RecordBatch], key: str, rows: int = 200_000, whole: bool = False) -> Iterator[tuple[pa.Table, bool]]:
    """Sorted rows in blocks that end with a group; a longer group comes in
    parts, or with ``whole`` as one block all the same.

    True with a block whose last group goes on in the next one.
    """
    held: list[pa.RecordBatch] = []
    size, due = 0, rows
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < due:
            continue
        table = pa.Table.from_batches(held)
        keys = table[key].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if whole and not cut:
            due = 2 * size  # looked at again when it has doubled
            continue
        due = rows
        if cut:
            yield table.slice(0, cut), False
            table = table.slice(cut)
            held, size = table.to_batches(), table.num_rows
        else:
            yield table.slice(0, size - 1), True
            held, size = table.slice(size - 1).to_batches(), 1
    if size:
        yield pa.Table.from_batches(held), False


def _first_meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, token null) and, for large groups, tokens (null, rows, token)."""
    carried = 0
    for table, open_ in _blocks(batches, "token", GROUP_ROWS):
        token, sid, n, place = (table[name].to_numpy() for name in ("token", "sid", "n", "place"))
        fresh = np.append(True, (token[1:] != token[:-1]) | (sid[1:] != sid[:-1]))
        token, sid, n, place = token[fresh], sid[fresh], n[fresh], place[fresh]
        values, sizes = np.unique(token, return_counts=True)
        if carried:
            sizes[0] += carried
        # A group in parts is large in each of them.
        hot = sizes > GROUP
        carried = int(sizes[-1]) if open_ else 0
        pairs = _Pairs(sid)
        for left, right in group_pairs(token, n, place, GROUP):
            pairs.add(left, right)
        a, b = pairs.batch()
        told = hot.copy()
        if open_:
            told[-1] = False
        tokens = np.concatenate([np.zeros(len(a), np.int64), values[told]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([a, np.zeros(told.sum(), np.int64)])),
                pa.array(np.concatenate([b, sizes[told].astype(np.int64)])),
                pa.array(tokens, mask=np.arange(len(tokens)) < len(a)),
            ],
            ["a", "b", "token"],
        )


def _tile_pairs(batches: Iterator[pa.RecordBatch], forest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within tiles that the bitmaps let pass.

    With ``forest`` only as many as could join the components of a tile. A tile
    is taken whole: distinct sets are dealt to it by hash, some ``2 * TILE`` of
    each of two bands.
    """
    for table, _ in _blocks(batches, "tile", TILE_ROWS, whole=True):
        tile, sid, n, place, band, low, component = (table[name].to_numpy() for name in ("tile", "sid", "n", "place", "band", "low", "component"))
        bitmaps = folded(table["bitmap"].to_pylist(), BITS)
        sizes = n.astype(np.int64)
        pairs = _Pairs(sid)
        if forest:
            pairs.add(*_forest(tile, sid, sizes, place, band, low, component, bitmaps))
        else:
            for left, right in group_pairs(tile, n, place, differ=component):
                own = np.minimum(band[left], band[right]) == low[left]  # else it meets in another tile
                left, right = left[own], right[own]
                good = may_link(bitmaps[left], bitmaps[right], sizes[left], sizes[right])
                pairs.add(left[good], right[good])
        a, b = pairs.batch()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _forest(tile, sid, sizes, place, band, low, component, bitmaps) -> np.ndarray:
    """Pairs that could join a tile's components, nearest in size first.

    What a pair joins counts as one from then on, so a tile gives about as many
    pairs as it has components.
    """
    keys, label = np.unique(np.stack([tile, component]), axis=1, return_inverse=True)
    label = label.reshape(-1).copy()
    chosen = [np.zeros((2, 0), np.int64)]
    for left, right in group_pairs(tile, sizes, place, differ=label):
        own = np.minimum(band[left], band[right]) == low[left]
        left, right = left[own], right[own]
        good = may_link(bitmaps[left], bitmaps[right], sizes[left], sizes[right])
        if not good.any():
            continue
        left, right = left[good], right[good]
        ends = np.sort(np.stack([label[left], label[right]]), axis=0)
        _, first = np.unique(ends, axis=1, return_index=True)
        chosen.append(np.stack([left[first], right[first]]))
        joined, (near, far) = np.arange(keys.shape[1]), ends
        while True:
            before = joined.copy()
            least = np.minimum(joined[near], joined[far])
            np.minimum.at(joined, near, least)
            np.minimum.at(joined, far, least)
            joined = joined[joined]
            if (joined == before).all():
                break
        label[:] = joined[label]  # the scan goes on with these
    return np.concatenate(chosen, axis=1)


def _bitmaps_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        maps = [batch.column(name).to_pylist() for name in ("bitmap_a", "bitmap_b")]
        bits = np.array([8 * min(len(a), len(b)) for a, b in zip(*maps)], np.int64)
        sizes = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        good = np.zeros(len(bits), bool)
        for width in np.unique(bits):
            rows = np.flatnonzero(bits == width)
            ends = [folded([own[row] for row in rows], int(width)) for own in maps]
            good[rows] = may_link(*ends, *(size[rows] for size in sizes))
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets: dict[int, np.ndarray] = {}

    def of(sid: int, text: str) -> np.ndarray:
        if sid not in sets:
            if len(sets) > 256:
                sets.clear()
            sets[sid] = shingle_set(text)
        return sets[sid]

    for batch in pieces(batches):
        rows = zip(*[batch.column(name).to_pylist() for name in ("a", "b", "text_a", "text_b")])
        good = [linked(of(a, text_a), of(b, text_b)) for a, b, text_a, text_b in rows]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _check(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that link, by bitmaps and then by their texts."""
    for end in ("a", "b"):
        own = sets.select(F.col("sid").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("bitmap").alias(f"bitmap_{end}"))
        pairs = pairs.join(own, end)
    likely = stored(pairs.mapInArrow(_bitmaps_pass, "a long, b long"), "pairs")
    ends = likely.select(F.col("a").alias("sid")).union(likely.select(F.col("b").alias("sid"))).distinct()
    wanted = stored(ends.join(sets.select("sid", "doc_id", "text_hash"), "sid"), "ends")
    texts = _keyed(docs).join(few(wanted), ["doc_id", "text_hash"]).select("sid", "text")
    texts = stored(texts.dropDuplicates(["sid"]), "texts")
    for end in ("a", "b"):
        likely = likely.join(texts.select(F.col("sid").alias(end), F.col("text").alias(f"text_{end}")), end)
    return stored(likely.mapInArrow(_intersect, "a long, b long"), "links")


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the components of both ends; an end without links is its own."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("component").alias(f"component_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"component_{end}", F.coalesce(f"component_{end}", end))
    return pairs


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links between components."""
    between = _labelled(links, labels).select(F.col("component_a").alias("a"), F.col("component_b").alias("b"))
    joined = components(between).select(F.col("node").alias("component"), F.col("component").alias("under"))
    known = labels.join(joined, "component", "left").select("node", F.coalesce("under", "component").alias("component"))
    new = joined.select(F.col("component").alias("node"), F.col("under").alias("component")).join(labels, "node", "left_anti")
    return stored(known.unionByName(new), "components")


def link_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Links: 100 * intersection >= 75 * union of the five-word shingle sets.
    component_id is the smallest doc_id reached by links, its own included. A
    null or empty text, or one of white space, has no shingles and no links.
    Copies share a set and are linked through it. Rows of one doc_id are one
    document with the links of all its texts. A row with a null doc_id links
    with nothing and has a null component. Other columns are ignored.
    """
    rows = stored(_sets(docs), "sets")
    known = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "text_hash")).alias("least")
    sets = known.groupBy("sid", "n_shingles").agg(least, F.first("bitmap").alias("bitmap"))
    sets = stored(sets.select("sid", "n_shingles", "least.*", "bitmap"), "distinct")
    order = _most(_frequent_tokens(docs))[0]

    shared = docs.sparkSession.sparkContext.broadcast(order)
    by_token = _tokens(docs, shared).repartition("token").sortWithinPartitions("token", "n", "sid")
    met = stored(by_token.mapInArrow(_first_meeting, "a long, b long, token long"), "met")
    pairs = stored(met.where("token IS NULL").groupBy("a", "b").agg(F.count("*").alias("shared")), "pairs")
    likeliest = pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
    labels = components(_check(likeliest, sets, docs))
    rest = _labelled(pairs, labels).where("component_a != component_b").select("a", "b")
    labels = _joined(labels, _check(rest, sets, docs))

    # Beyond the bound of the broadcast every set takes part.
    crowded, every = _most(met.where("token IS NOT NULL").groupBy("token").agg(F.sum("b").alias("times")))
    if len(crowded.tokens) or every:
        orders = docs.sparkSession.sparkContext.broadcast((order, crowded, order.with_first(crowded)))
        # A copied set comes from several tasks, and counts once.
        tokens = stored(_tokens(docs, orders, every).dropDuplicates(["token", "sid"]), "tokens")
        # Twice the likeliest pairs alone, which leave few components; then all.
        for forest in (True, True, False):
            labels = _joined(labels, _check(_second_meeting(tokens, sets, labels, forest), sets, docs))
    return _by_document(rows, labels)


def _most(tokens: DataFrame) -> tuple[Order, bool]:
    """The most frequent tokens, up to the bound, and whether there are more.

    Levels of frequency are counted first, so that no task sorts all tokens;
    a level that would exceed the bound stays out whole.
    """
    listed = stored(tokens.withColumn("level", F.floor(F.log2(F.col("times").cast("double")) * 8)), "frequent")
    kept, least, levels = 0, None, listed.groupBy("level").count().orderBy(F.desc("level")).collect()
    for row in levels:
        kept += row["count"]
        if kept > MOST_HOT:
            break
        least = row["level"]
    most = listed.where(F.col("level") >= least if least is not None else F.lit(False)).select("token", "times").toArrow()
    return Order(most["token"].to_numpy(), most["times"].to_numpy()), kept > MOST_HOT


def _second_meeting(tokens: DataFrame, sets: DataFrame, labels: DataFrame, forest: bool) -> DataFrame:
    """Pairs of different components that meet when crowded tokens come last."""
    own = labels.select(F.col("node").alias("sid"), "component")
    rows = tokens.join(own, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    stats = rows.groupBy("token").agg(F.count("*").alias("rows"), F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = stored(stats.where("least != most").select("token", "rows"), "mixed")
    rows = rows.join(mixed, "token").join(sets.select("sid", "bitmap"), "sid")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int")
    sides = F.ceil(F.col("rows") / TILE).cast("int")
    mine, other = F.pmod(F.xxhash64("sid"), "sides").cast("int"), F.col("other")
    rows = (
        rows.withColumns({"band": band, "sides": sides})
        .withColumn("mine", mine)
        .withColumn("low", F.explode(F.array(F.col("band") - 1, F.col("band"))))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .withColumn("tile", F.xxhash64("token", "low", F.least("mine", other), F.greatest("mine", other)))
    )
    tiles = rows.select("tile", "sid", "n", "place", "band", "low", "component", "bitmap").repartition("tile").sortWithinPartitions("tile", "n", "sid")
    return tiles.mapInArrow(lambda batches: _tile_pairs(batches, forest), "a long, b long").distinct()


def _by_document(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The smallest doc_id of each component, for every row."""
    own = labels.select(F.col("node").alias("sid"), "component")
    # Rows of one doc_id with several texts are links, too.
    with_sets = rows.select("doc_id", "n_shingles", "sid").join(own, "sid", "left")
    linked_rows = stored(with_sets.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "sid"))), "rows")
    several = linked_rows.where("component IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.collect_set("component").alias("all")).where("a != b")
    extra = several.select("a", F.explode("all").alias("b")).where("a != b")
    if extra.limit(1).count():
        joined = components(extra).select(F.col("node").alias("component"), F.col("component").alias("under"))
        linked_rows = stored(linked_rows.join(joined, "component", "left").withColumn("component", F.coalesce("under", "component")).drop("under"), "rows")
    least = stored(linked_rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    named = linked_rows.join(least, "component", "left")
    # A row without shingles, or without an id, stands alone, but for the other texts of its id.
    return named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents without near duplicates: of each component the smallest doc_id.

    Rows that repeat a doc_id are one document: they stay or go together. Rows
    with a null doc_id and rows without shingles stay. Columns pass through.
    """
    found = link_components(docs).where("doc_id IS NOT NULL AND doc_id != component_id").select("doc_id").distinct()
    return docs.join(few(stored(found, "near-copies")), "doc_id", "left_anti").select(*[F.col(f"`{name}`") for name in docs.columns])
