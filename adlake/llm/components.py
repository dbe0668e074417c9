"""Connected components of links, as Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.shared import stored

BLOCK = 1 << 18  # links looked at together within a task


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the links of a block by links to each local group's smallest node."""
    parts: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        ends = np.stack([table["a"].to_numpy(), table["b"].to_numpy()])
        nodes, places = np.unique(ends, return_inverse=True)
        left, right = places.reshape(ends.shape)
        label = np.arange(len(nodes))
        while True:  # least label over links, then over the labels' own labels
            before = label.copy()
            least = np.minimum(label[left], label[right])
            np.minimum.at(label, label[left], least)
            np.minimum.at(label, label[right], least)
            label = label[label]
            if (label == before).all():
                break
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[label[moved]]), pa.array(nodes[moved])], ["a", "b"])

    for batch in batches:
        parts.append(batch)
        if sum(part.num_rows for part in parts) >= BLOCK:
            yield flush()
            parts = []
    if parts:
        yield flush()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); component: smallest node.

    Tasks first contract their own links, so what is left is shallow. Then
    each node takes the least label around it and that label's own label,
    until nothing changes; every round is a written table. A node of many
    links is pre-aggregated in each task.
    """
    local = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    short = stored(local.mapInArrow(_contract, "a long, b long").distinct(), "links")
    both = short.unionByName(short.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    while True:
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("from"))
        around = both.join(known, "a").groupBy("b").agg(F.min("from").alias("least"))
        better = labels.join(around, F.col("node") == F.col("b")).select("node", F.col("component").alias("old"), F.least("component", "least").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        step = better.join(jump, "near").select("node", "old", F.least("near", "far").alias("component"))
        step = stored(step, "labels")
        changed = step.where("old != component").limit(1).count()
        labels = step.select("node", "component")
        if not changed:
            return labels
