from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlake.llm import jaccard_join
from adlake.llm.components import components
from adlake.llm.jaccard_join import keep_one, link_components, parity_bitmap, shingle_set


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Component of each doc_id; ids are distinct."""
    sets = {number: shingles(text) for number, text in rows}
    label = {number: number for number in sets}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            low, high = sorted((top(a), top(b)))
            label[high] = low
    return {number: (len(own), top(number)) for number, own in sets.items()}


def corpus():
    draw = random.Random(6)
    words = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    passage, rows = words(60), []
    for family in range(6):  # near copies, more than meet at once
        base = words(draw.randrange(30, 150))
        for _ in range(40 if family == 0 else 7):
            copy = list(base)
            for _ in range(draw.randrange(0, 5)):
                copy[draw.randrange(len(copy))] = "edit" + str(draw.randrange(9))
            rows.append(copy)
    rows += [words(draw.randrange(5, 40)) + passage + words(draw.randrange(1, 40)) for _ in range(60)]
    rows += [passage + words(draw.randrange(0, 25)) for _ in range(40)]
    rows += [words(n) for n in (1, 2, 3, 4, 5, 6)] + [["Same", "few"], ["same", "FEW"], []]
    draw.shuffle(rows)
    return [(number, " ".join(row)) for number, row in enumerate(rows)]


@pytest.mark.parametrize("group, tile, hot", [(16, 2048, 1 << 20), (3, 4, 1 << 20), (3, 4, 2)])
def test_against_all_pairs(make, monkeypatch, group, tile, hot):
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "MOST_HOT", hot)
    rows = corpus()
    found = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in link_components(make(rows)).collect()}
    assert found == brute(rows)


def test_a_tile_beyond_a_block_meets_whole(monkeypatch):
    """All pairs of a tile of 300 rows in blocks of 50 that come in batches of 20."""
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", 50)
    draw = np.random.default_rng(1)
    sizes = np.concatenate([np.sort(draw.integers(30, 90, rows)) for rows in (5, 300, 7)]).astype(np.int32)
    count = len(sizes)
    tile = np.repeat([1, 2, 3], [5, 300, 7])
    table = pa.table(
        {
            "tile": tile, "sid": np.arange(count), "n": sizes, "place": np.zeros(count, np.int32), "band": np.full(count, 12, np.int32),
            "low": np.full(count, 12, np.int32), "component": np.arange(count) % 250, "bitmap": pa.array([bytes(256)] * count, pa.binary()),
        }
    )
    found = [(row["a"], row["b"]) for batch in jaccard_join._tile_pairs(iter(table.to_batches(20)), False) for row in batch.to_pylist()]
    expected = {
        (a, b) for a, b in combinations(range(count), 2)
        if tile[a] == tile[b] and a % 250 != b % 250 and 4 * min(sizes[a], sizes[b]) >= 3 * max(sizes[a], sizes[b])
    }
    assert (5, 304) not in expected or (5, 304) in found
    assert sorted(found) == sorted(expected) and len(expected) > 10_000


def test_words_and_bitmaps():
    assert len(shingle_set("A b\x0bc\x0cd e\x1cf g")) == len(shingles("A b\x0bc\x0cd e\x1cf g")) == 2
    assert (shingle_set("ÀB c") != shingle_set("àb c")).all() and (shingle_set("AB c") == shingle_set("ab C")).all()
    long = " ".join(f"x{n}" for n in range(300_000))
    assert len(shingle_set(long)) == 300_000 - 4
    assert parity_bitmap(shingle_set("a b")) != parity_bitmap(shingle_set("a c"))


def test_odd_rows(odd, empty):
    frame = odd.withColumn("sid", F.lit("clash"))
    found = sorted(((row["doc_id"], row["n_shingles"], row["component_id"]) for row in link_components(frame).collect()), key=str)
    assert len(found) == odd.count()
    assert all(component == {6: 5}.get(number, number) for number, _, component in found)
    kept = keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert link_components(empty).count() == 0


def test_one_id_with_several_texts(make):
    a, b = ("one two three four five six", "seven eight nine ten eleven twelve")
    found = {row["doc_id"]: row["component_id"] for row in link_components(make([(3, a), (3, b), (2, a), (5, b)])).collect()}
    assert found == {2: 2, 3: 2, 5: 2}


def test_near_copies_under_ids_with_several_texts(make):
    texts = [" ".join(f"t{n}w{at}" for at in range(60)) for n in range(12)]
    rows = [(3, text) for text in texts] + [(100 + n, text + " edit") for n, text in enumerate(texts)]
    found = {(row["doc_id"], row["component_id"]) for row in link_components(make(rows)).collect()}
    assert found == {(number, 3) for number, _ in rows}


def test_components_of_a_long_chain(spark):
    order = list(range(3000))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([*zip(order, order[1:]), (9001, 9000), (9002, 9002)], "a long, b long")
    found = {row["node"]: row["component"] for row in components(links.repartition(8)).collect()}
    assert set(found.values()) == {0, 9000} and found[9001] == 9000 and len(found) == 3002
