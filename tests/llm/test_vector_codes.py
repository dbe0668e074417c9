from __future__ import annotations

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from adlake.llm.vector_codes import assign, compress, exact_kind

SCHEMA = "vec_id long, embedding array<float>, label int"


def distance(left, right):
    return sum((a - b) ** 2 for a, b in zip(left, right))


def brute(rows, parts=8, count=16, rounds=6):
    """Plain rounds over all entries."""
    kept = [(v, [math.floor(4096 * x) for x in e], label) for v, e, label in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return []
    width = max(1, -(-max(len(e) for _, e, _ in kept) // parts))
    cut = [[(e + [0] * (width * parts))[p * width : (p + 1) * width] for p in range(parts)] for _, e, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = [[cut[i][p] for i in order[:count]] for p in range(parts)]

    def nearest(p):
        return [min(range(len(books[p])), key=lambda e: (distance(one[p], books[p][e]), e)) for one in cut]

    for _ in range(rounds):
        for p in range(parts):
            codes = nearest(p)
            for e in range(len(books[p])):
                mine = [cut[i][p] for i, code in enumerate(codes) if code == e]
                if mine:
                    books[p][e] = [sum(column) // len(mine) for column in zip(*mine)]
    codes = [nearest(p) for p in range(parts)]
    errors = [sum(distance(one[p], books[p][codes[p][i]]) for p in range(parts)) for i, one in enumerate(cut)]
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    held = [error if error < 2**63 else None for error in errors]
    by_label = {label: error if error < 2**63 else None for label, error in by_label.items()}
    return sorted(
        ((v, "".join(f"{codes[p][i]:02x}" for p in range(parts)), held[i], by_label[label], digest) for i, (v, _, label) in enumerate(kept)),
        key=str,
    )


def found(spark, rows, partitions=5):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"codes": F.lit("clash"), "error": F.lit(1.5), "_total": F.lit(0)})
    return sorted((tuple(row) for row in compress(frame.repartition(partitions)).collect()), key=str)


def test_rings_find_what_all_entries_find():
    draw = np.random.default_rng(3)
    for spread, kind in ((4, np.float64), (40, np.int64), (40, object)):
        entries = draw.integers(-spread, spread, (16, 2)).astype(kind)
        entries[9] = entries[2]  # equal entries: the lower index
        points = draw.integers(-spread, spread, (600, 2)).astype(kind)
        everything = np.array([[distance(point, entry) for entry in entries] for point in points])
        codes = draw.integers(0, 16, 600)
        for _ in range(2):
            codes, best = assign(points, codes, entries, np.ones(16, bool))
            assert codes.tolist() == everything.argmin(axis=1).tolist()
            assert best.tolist() == everything.min(axis=1).tolist()
        moved = np.zeros(16, bool)
        moved[[1, 5]] = True
        entries[moved] += 1
        codes, _ = assign(points, codes, entries, moved)
        assert codes.tolist() == [min(range(16), key=lambda e: (distance(point, entries[e]), e)) for point in points]


def test_number_types_are_exact():
    assert exact_kind(4096, 64) is np.float64
    assert exact_kind(2**28, 8) is np.int64
    assert exact_kind(2**40, 8) is object


def test_against_plain_rounds(spark):
    draw = random.Random(4)
    rows = [(v, [round(draw.gauss(0, 0.3), 2) for _ in range(16)], draw.choice([None, 0, 1, 1, 1])) for v in range(3, 200)]
    rows += [(v + 1000, [0.5] * 16, 2) for v in range(150)]  # one vector holds a third of the rows
    assert found(spark, rows) == brute(rows)


def test_on_a_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert sorted(map(tuple, compress(table).collect()), key=str) == brute([tuple(row) for row in table.select("vec_id", "embedding", "label").collect()])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [nan] * 8, 0), (3, [inf, 0.0], 1), (4, [0.5, None], 1), (None, [0.25] * 8, None), (5, [], 1), (6, [1.0, -2.0, 3.0], None), (7, [0.1] * 11, 3), (7, [0.1] * 11, 3), (7, [0.0] * 11, 3)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:4]) == []
    assert found(spark, rows[:0]) == []


def test_components_beyond_doubles(spark):
    rows = [(v, [float((-1) ** v * 2 ** (20 + v % 9)), 0.125 * v] * 4, 0) for v in range(40)]
    assert found(spark, rows) == brute(rows)
    rows = [(1, [2.0**127, 1.0], 0), (2, [-(2.0**127), 1.0], 0), *[(v, [1.0 * v, 0.0], 0) for v in range(3, 40)]]
    assert found(spark, rows) == brute(rows)
