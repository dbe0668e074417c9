from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from adlake.llm import sharding
from adlake.llm.sharding import moves_allowed, shard_documents


def check(rows, shards=8):
    counts = Counter(row["shard"] for row in rows)
    sizes = [counts.get(shard, 0) for shard in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for shard in range(shards):
        assert sorted(row["slot"] for row in rows if row["shard"] == shard) == list(range(sizes[shard]))
    return sizes


def test_groups_stay_together(make):
    docs = make([(at, f"text {at % 150 if at < 600 else at}") for at in range(2000)])
    rows = shard_documents(docs.withColumn("shard", F.lit("clash"))).collect()
    check(rows)
    places = {}
    for row in rows:
        places.setdefault(row["doc_id"] % 150 if row["doc_id"] < 600 else None, set()).add(row["shard"])
    cut = sum(len(found) > 1 for group, found in places.items() if group is not None)
    assert cut == 0
    for row in rows:
        text = f"text {row['doc_id'] % 150 if row['doc_id'] < 600 else row['doc_id']}".encode()
        assert (row["size"], row["text_crc32"], row["law"], row["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)


def test_a_group_of_a_third_is_cut_as_little_as_sizes_allow(make, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_IN_BUCKET", 100)
    docs = make([(at, "same" if at < 700 else f"text {at}") for at in range(2000)])
    rows = shard_documents(docs).collect()
    check(rows)
    assert len({row["shard"] for row in rows if row["doc_id"] < 700}) == 3


def test_odd_rows(odd, empty):
    rows = shard_documents(odd).collect()
    check(rows)
    assert sum(row["size"] for row in rows if row["doc_id"] == 3) == 1
    assert [row["text_crc32"] for row in rows if row["doc_id"] in (1, 3)] == [0, 0]
    assert shard_documents(empty).count() == 0


def test_quotas_keep_sizes():
    wanted = {(0, 1): 50, (1, 0): 20, (2, 1): 30}
    allowed = moves_allowed(wanted, [100, 100, 100], [110, 110, 110])
    counts = [100, 100, 100]
    for (start, end), n in allowed.items():
        assert n <= wanted[start, end]
        counts[start] -= n
        counts[end] += n
    assert max(counts) <= 110 and allowed[1, 0] == 20
