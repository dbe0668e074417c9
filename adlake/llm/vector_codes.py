"""Product codes of vectors: one codebook per part, trained by ball k-means.

A codebook's entry is the centre of a ball around the parts assigned to it. For
a part at distance d from its own entry, an entry at distance D from that one
can be as near only if D <= 2d. So a ball's radius names its neighbours; parts
within half the distance to the nearest neighbour are the stable core and stay;
the rest lie in rings, each between two neighbours' half distances, and are
held against the neighbours inside their ring only. Where neither the own entry
nor a neighbour moved since the last assignment, nothing is compared at all.
Everything is whole numbers, so codes and codebooks are exact.

Codebooks and their partial sums are a few kilobytes whatever the number of
vectors; vectors stay in their tasks from round to round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.shared import pieces

SCALE = 4096.0
MOST_ENTRIES = 256  # a code is one byte a part
HALF = 10**18  # sums travel as two decimals, which hold any sum of floats
STATE = "vec_id long, label string, vector binary, codes binary"


@dataclass(frozen=True)
class Codebooks:
    """``entries`` by part, entry and component, and which of them moved last.

    ``kind`` holds all differences, squares and their sums exactly.
    """

    entries: np.ndarray
    moved: np.ndarray
    kind: type


def exact_kind(largest: int, width: int) -> type:
    """A number type in which squared distances of such components are exact."""
    squared = (2 * largest + 2) ** 2 * max(1, width)
    return np.float64 if squared < 2**53 else np.int64 if squared < 2**63 else object


def sound(vector):
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def scaled(vectors: list[list[float]], width: int) -> np.ndarray:
    """floor(4096 * component) as doubles, which hold it exactly; short vectors
    are filled with zeros."""
    out = np.zeros((len(vectors), width))
    for at, vector in enumerate(vectors):
        out[at, : len(vector)] = vector
    return np.floor(out * SCALE)


def whole(values: np.ndarray, kind: type) -> np.ndarray:
    """Doubles of whole numbers in the given number type."""
    if kind is object:
        return np.array([[int(value) for value in row] for row in values], object).reshape(values.shape)
    return values.astype(kind)


def squared_distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return (apart * apart).sum(axis=-1)


def assign(points: np.ndarray, codes: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point, ties to the lower index, and its squared
    distance; ``codes`` are the nearest ones before ``moved`` entries moved."""
    own = squared_distances(points, entries[codes])
    best, nearest = own.copy(), codes.copy()
    for entry in np.unique(codes):
        members = np.flatnonzero(codes == entry)
        reach = 4 * own[members]  # (2d) squared
        apart = squared_distances(entries, entries[entry])
        others = [other for other in range(len(entries)) if other != entry and apart[other] <= reach.max() and (moved[entry] or moved[other])]
        if not others:
            continue
        # Members by distance: those within reach of a neighbour are a tail,
        # which gets shorter from ring to ring.
        members = members[np.argsort(reach, kind="stable")]
        reach = 4 * own[members]
        for other in sorted(others, key=lambda other: apart[other]):
            ring = members[np.searchsorted(reach, apart[other], side="left") :]
            found = squared_distances(points[ring], entries[other])
            wins = (found < best[ring]) | ((found == best[ring]) & (other < nearest[ring]))
            nearest[ring[wins]], best[ring[wins]] = other, found[wins]
    return nearest, best


def _points(batch: pa.RecordBatch, parts: int, kind: type) -> np.ndarray:
    rows = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64)
    return whole(rows.reshape(batch.num_rows, -1), kind).reshape(batch.num_rows, parts, -1)


def _codes(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, parts).astype(np.int64)


def _reassigned(state: DataFrame, books: Codebooks) -> DataFrame:
    """The state after one assignment, with the squared distances' sum as text."""
    parts = len(books.entries)
    shared = state.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in pieces(batches):
            if not batch.num_rows:
                continue
            points, codes = _points(batch, parts, books.kind), _codes(batch, parts)
            error = np.zeros(batch.num_rows, books.kind)
            for part in range(parts):
                codes[:, part], found = assign(points[:, part], codes[:, part], books.entries[part], books.moved[part])
                error = error + found
            packed = codes.astype(np.uint8)
            arrays = [batch.column(name) for name in ("vec_id", "label", "vector")]
            arrays += [pa.array([row.tobytes() for row in packed], pa.binary()), pa.array([str(int(value)) for value in error], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "vector", "codes", "error"])

    return state.drop("error").mapInArrow(run, f"{STATE}, error string")


def _moved_entries(state: DataFrame, books: Codebooks) -> Codebooks:
    """Every used entry at the floor of its parts' mean.

    A task sums its own rows; one row per task, part, entry and component is
    added up by Spark, and one per part, entry and component reaches the driver.
    """
    parts, count, width = books.entries.shape
    kind = books.kind

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, count, width + 1), object)  # the last column counts
        for batch in pieces(batches):
            if not batch.num_rows:
                continue
            points, codes = _points(batch, parts, kind), _codes(batch, parts)
            points = points if kind is object else points.astype(np.int64)
            for part in range(parts):
                here = np.zeros((count, width), points.dtype)
                np.add.at(here, codes[:, part], points[:, part])
                totals[part, :, :width] += here.astype(object)
                totals[part, :, width] += np.bincount(codes[:, part], minlength=count).astype(object)
        used = np.argwhere(totals[:, :, width] > 0)
        names = ("part", "entry", "at", "high", "low")
        rows = [(int(p), int(e), at, *divmod(totals[p, e, at], HALF)) for p, e in used for at in range(width + 1)]
        columns = list(zip(*rows)) or [()] * len(names)
        types = [pa.int32()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(map(str, c) if t == pa.string() else c, t) for c, t in zip(columns, types)], list(names))

    partial = state.select("vector", "codes").mapInArrow(sums, "part int, entry int, at int, high string, low string")
    added = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("high", "low")]
    rows = partial.groupBy("part", "entry", "at").agg(*added).collect()
    totals = {(row["part"], row["entry"], row["at"]): int(row["high"]) * HALF + int(row["low"]) for row in rows}
    entries = books.entries.copy()
    for part, entry, at in totals:
        if at < width:
            entries[part, entry, at] = totals[part, entry, at] // totals[part, entry, width]
    return Codebooks(entries, (entries != books.entries).any(axis=2), kind)


def _seeds(kept: DataFrame, parts: int, count: int, kind: type, width: int) -> Codebooks:
    """The parts of the vectors of smallest id; of equal ids, by their components."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(count).collect()
    entries = whole(scaled([row["embedding"] for row in first], width), kind).reshape(len(first), parts, -1)
    entries = np.ascontiguousarray(entries.transpose(1, 0, 2))
    return Codebooks(entries, np.ones(entries.shape[:2], bool), kind)


def train_codes(vectors: DataFrame, parts: int = 8, count: int = 16, rounds: int = 6) -> tuple[DataFrame, Codebooks]:
    """Codes of all kept vectors and the final codebooks.

    The frame has ``vec_id``, ``label`` (as text), ``codes`` (a byte per part)
    and ``error`` (decimal). It is cached, on disk where memory is short; a lost
    executor's rows are made again from the table, since no step shuffles them.
    """
    if not 0 < count <= MOST_ENTRIES:
        raise ValueError(f"a codebook has 1 to {MOST_ENTRIES} entries")
    spark = vectors.sparkSession
    kept = vectors.where(sound(F.col("embedding"))).select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    largest, width, rows = kept.agg(
        F.max(F.aggregate("embedding", F.lit(0.0), lambda most, x: F.greatest(most, F.abs(x)))), F.max(F.size("embedding")), F.count(F.lit(1))
    ).first()
    if not rows:
        nothing = spark.createDataFrame([], "vec_id long, label string, codes binary, error decimal(38,0)")
        return nothing, Codebooks(np.zeros((parts, 0, 0)), np.zeros((parts, 0), bool), np.float64)
    width = max(1, -(-width // parts)) * parts
    kind = exact_kind(int(largest * SCALE) + 1, width)
    books = _seeds(kept, parts, count, kind, width)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = scaled(batch.column("embedding").to_pylist(), width)
            vector, codes = pa.array([row.tobytes() for row in made], pa.binary()), pa.array([bytes(parts)] * len(made), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), vector, codes], ["vec_id", "label", "vector", "codes"])

    state, earlier = kept.mapInArrow(start, STATE), None
    for _ in range(rounds):
        state = _reassigned(state, books).persist(StorageLevel.MEMORY_AND_DISK)
        books = _moved_entries(state, books)
        if earlier is not None:
            earlier.unpersist()
        earlier = state
    found = _reassigned(state, books).select("vec_id", "label", "codes", F.col("error").try_cast("decimal(38,0)").alias("error"))
    return found, books


def digest(books: Codebooks) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(value)) for value in books.entries.reshape(-1)).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 8, count: int = 16, rounds: int = 6) -> DataFrame:
    """One row per kept vector: its code in hex, its error, and the digest of
    the codebooks that read it.

    Vectors that are null or hold a null, NaN or infinite component are left
    out. A vector shorter than the longest one, or whose length the parts do not
    divide, is filled with zeros. Fewer vectors than entries make smaller
    codebooks. Repeated ids are rows of their own; of equal ids the one with the
    smaller components comes first among the seeds, and null ids come last. An
    empty table gives no rows. ``label_error`` adds up the error over equal
    labels; null labels are one label. Components may be anything a float holds;
    sums beyond 64 bits are null. Other columns are not carried.
    """
    found, books = train_codes(vectors, parts, count, rounds)
    # Partial sums meet per label, so a frequent label is one row per task; its
    # total is joined back without ordering or gathering its vectors.
    totals = found.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("_total"), F.count_if(F.col("error").isNull()).alias("_unknown"))
    joined = found.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select(
        "vec_id",
        F.lower(F.hex("codes")).alias("code"),
        F.col("error").try_cast("long").alias("error"),
        F.when(F.col("_unknown") == 0, F.col("_total")).try_cast("long").alias("label_error"),
        F.lit(digest(books)).alias("codebooks_sha256"),
    )
