from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from adlake.llm import topk_search
from adlake.llm.topk_search import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    sound = [(v, [math.floor(256 * x) for x in e]) for v, e, _ in rows if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, left in sound:
        if q % 5:
            continue
        scored = sorted((-sum(a * b for a, b in zip(left, right)), v) for v, right in sound if v != q)
        out += [(q, at + 1, v, -s) for at, (s, v) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, k=5, blocks=2):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash"))
    return sorted(tuple(row) for row in exact_top_k(frame, F.col("vec_id") % 5 == 0, k, blocks).collect())


def test_against_all_pairs_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CELL_QUERIES", 7)
    monkeypatch.setattr(topk_search, "CELL_CANDIDATES", 31)
    draw = random.Random(2)
    rows = [(v, [draw.choice([-0.5, 0.0, 0.25, draw.random()]) for _ in range(6)], 0) for v in range(150)]
    rows += [(v + 1000, list(rows[3][1]), 0) for v in range(40)]  # ties
    rows += [(2000, None, 0), (2005, [float("nan")] * 6, 0), (2010, [1.0, None], 0), (2015, [float("inf")], 0), (None, [1.0], 0), (2020, [], 0), (2025, [0.5, 0.5], 0)]
    assert found(spark, rows) == brute(rows, 5)
    assert found(spark, rows, 3, 3) == brute(rows, 3)


def test_few_repeated_and_no_rows(spark):
    rows = [(0, [1.0, -2.0], 0), (3, [0.5, 0.5], 0), (3, [0.5, 0.5], 0)]
    assert found(spark, rows) == [(0, 1, 3, -65536 // 2), (0, 2, 3, -65536 // 2)]
    assert found(spark, [(0, [1.0], 0)]) == []
    assert found(spark, rows[:0]) == []
    assert found(spark, [(0, [1e6, 1.0], 0), (1, [1e6, 1.0], 0)]) == [(0, 1, 1, 256000000**2 + 65536)]
