"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import scratch_dir

# Stands for a null document id in join keys; only rows whose text is the same
# as well could be mistaken for one another.
NO_ID = -(2**63)
BROADCAST_ROWS = 1_000_000  # of ids: some 16 MB
PIECE_BYTES = 4 << 20  # turned into Python values at once
RADIX = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []
_kept: dict[str, object] = {}
_in_use: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared checkpoint folder: ends its lineage."""
    folder = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def few(ids: DataFrame) -> DataFrame:
    """Marked for broadcast where few enough; a shuffle join otherwise."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def row_key() -> list[Column]:
    """Key columns of a document row: its id and a hash of its text.

    Rows that repeat both are the same document and share every decision; a
    null id is a value like any other.
    """
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("text").alias("_hash"),
    ]


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of some ``PIECE_BYTES``, one row at least."""
    for batch in batches:
        rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def pieces_of(array: pa.Array) -> Iterator[pa.Array]:
    """The array in slices of some ``PIECE_BYTES``, one value at least."""
    values = max(1, len(array) * PIECE_BYTES // max(1, array.nbytes))
    for start in range(0, len(array), values):
        yield array.slice(start, values)


def kept(key: str, make: Callable[[], object]) -> object:
    """What an operator keeps in a Python worker from task to task, such as a
    vocabulary and its cache: one thing at a time."""
    _in_use.add(key)
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def add_columns(frame: DataFrame, column: str, added: dict[str, str], start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """Columns that Python makes of one column, batch by batch, through Arrow.

    ``start`` is called once in each task and gives the function from a list
    of values to one sequence per added column. All other columns pass through
    as they are; those with an added column's name are replaced.
    """
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    kinds |= {f"array<{name}>": pa.list_(kind) for name, kind in list(kinds.items())}
    own = frame.drop(*added)
    # Columns go by their places, so any name will do.
    names = [*own.columns, *added]
    places = [f"c{at}" for at in range(len(names))]
    source, schema = places[own.columns.index(column)], [*[kind for _, kind in own.dtypes], *added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _in_use.clear()
        function = start()
        if not _in_use:  # another operator's turn
            _kept.clear()
        for batch in pieces(batches):
            made = [pa.array(values, kinds[kind]) for kind, values in zip(added.values(), function(batch.column(source).to_pylist()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], places)

    placed = own.toDF(*places[: len(own.columns)]).mapInArrow(run, ", ".join(f"{place} {kind}" for place, kind in zip(places, schema)))
    return placed.toDF(*names)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def of_hash(column: str | Column, parts: int, remainder: int) -> Column:
    """Whether crc32 of the column as text leaves this remainder."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % parts == remainder


def chunks(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Slices of consecutive items with about ``most`` in all, one item at least."""
    start = total = end = 0
    for size in sizes:
        if end > start and total + size > most:
            yield slice(start, end)
            start, total = end, 0
        total += size
        end += 1
    if end > start:
        yield slice(start, end)


def mix64(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over the whole range (a bijection)."""
    values = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    return values ^ (values >> np.uint64(31))


def radix_powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd radix and of its inverse, modulo 2 to the 64."""
    if not _powers or len(_powers[0]) < length:
        size = max(length, 1 << 21)
        _powers[:] = [np.cumprod(np.append(np.uint64(1), np.full(size, base, np.uint64))) for base in (RADIX, pow(RADIX, -1, 1 << 64))]
    return _powers[0], _powers[1]


def substring_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial of the bytes of each substring, not yet mixed."""
    powers, inverse = radix_powers(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * powers[: len(flat)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]
