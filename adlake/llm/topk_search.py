"""Exact top-k search by inner product: three phases with one uniform threshold.

The components of every vector are split into blocks; each block is a node with
a partial score for every pair of query and candidate. A score is the sum of
its partial scores.

1. Each node gathers its best k partial scores of a query. The exact scores of
   these entries give a cutoff: the k-th best cannot be lower.
2. The cutoff goes to all nodes; each returns the entries whose partial score is
   at least cutoff / blocks. An entry missing everywhere has a sum below the
   cutoff, so no entry of the result is missing.
3. Partial scores still missing are fetched for the entries that were returned,
   and the best k exact sums remain.

A node's work is laid out as a grid of cells: some queries against some
candidates. Queries are only the stated set, and rows meet only inside cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.shared import stored

CELL_QUERIES = 1024
CELL_CANDIDATES = 16_384
SLICE = 1 << 21  # scores held at once


def scaled(vector: Column) -> Column:
    """floor(256 * component), each taken as double; null where a vector is
    null or holds a component that is null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))


def multiply(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of whole numbers, exactly; sums beyond 64 bits wrap."""
    bound = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def _cells(queries: DataFrame, candidates: DataFrame, blocks: int, asks: DataFrame | None = None, cutoffs: DataFrame | None = None) -> DataFrame:
    """Rows of all grid cells: kind 0 queries, 1 candidates, 2 entries asked for.

    A query stands in every cell column and a candidate in every cell row; the
    cells of a row or column are numbered, so a cell's rows are bounded by the
    two sizes above whatever the vectors are.
    """
    rows = max(1, -(-queries.count() // CELL_QUERIES))
    columns = max(1, -(-candidates.count() // CELL_CANDIDATES))
    across, down = F.sequence(F.lit(0), F.lit(columns - 1)), F.sequence(F.lit(0), F.lit(rows - 1))

    def part(name: str, count: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(count)).cast("int")

    if cutoffs is not None:
        queries = queries.join(cutoffs, "query", "left")
    else:
        queries = queries.withColumn("cutoff", F.lit(None).cast("long"))
    none = F.lit(None).cast("long")
    each_block = F.posexplode("blocks").alias("block", "vector")
    frames = [
        queries.select(each_block, F.col("query"), none.alias("row"), "cutoff", "id")
        .select(F.lit(0).alias("kind"), "block", part("query", rows).alias("down"), F.explode(across).alias("across"), "query", "row", "cutoff", "id", "vector"),
        candidates.select(each_block, none.alias("query"), "row", none.alias("cutoff"), "id")
        .select(F.lit(1).alias("kind"), "block", F.explode(down).alias("down"), part("row", columns).alias("across"), "query", "row", "cutoff", "id", "vector"),
    ]
    if asks is not None:
        empty = F.array().cast("array<long>").alias("vector")
        frames.append(asks.select(F.lit(2).alias("kind"), "block", part("query", rows).alias("down"), part("row", columns).alias("across"), "query", "row", none.alias("cutoff"), none.alias("id"), empty))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _answer(cell: pd.DataFrame, k: int, blocks: int, asking: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, row and partial score of what one cell returns."""
    asked = cell[cell["kind"] == 2]
    queries = cell[cell["kind"] == 0].sort_values("query", kind="stable")
    candidates = cell[cell["kind"] == 1].sort_values("row", kind="stable")
    width = max([0, *map(len, queries["vector"]), *map(len, candidates["vector"])])
    if not (len(queries) and len(candidates)):
        return
    left, right = _matrix(queries["vector"], width), _matrix(candidates["vector"], width)
    query, row = queries["query"].to_numpy(np.int64), candidates["row"].to_numpy(np.int64)
    if asking:
        at = np.searchsorted(query, asked["query"].to_numpy(np.int64))
        to = np.searchsorted(row, asked["row"].to_numpy(np.int64))
        for start in range(0, len(at), SLICE // max(1, width)):
            part = slice(start, start + SLICE // max(1, width))
            yield query[at[part]], row[to[part]], np.einsum("ij,ij->i", left[at[part]], right[to[part]])
        return
    own, other = queries["id"].to_numpy(np.int64), candidates["id"].to_numpy(np.int64)
    limit = queries["cutoff"]
    known = limit.notna().to_numpy()
    # At least one of several parts of a sum reaches the sum over their number.
    least = -(-limit.fillna(0).to_numpy(np.int64) // blocks)
    step = max(1, SLICE // len(row))
    for start in range(0, len(query), step):
        part = slice(start, start + step)
        scores = multiply(left[part], right)
        allowed = own[part, None] != other[None]
        if known.any():
            at, to = np.nonzero(allowed & ((scores >= least[part, None]) | ~known[part, None]))
        else:
            scores[~allowed] = np.iinfo(np.int64).min
            best = min(k, len(row))
            to = np.argpartition(scores, len(row) - best, axis=1)[:, len(row) - best :].ravel()
            at = np.repeat(np.arange(len(scores)), best)
            kept = allowed[at, to]
            at, to = at[kept], to[kept]
        yield query[part][at], row[to], scores[at, to]


def _partial_scores(cells: DataFrame, k: int, blocks: int, asking: bool = False) -> DataFrame:
    """What the cells return: with ``asking`` the scores of the entries asked
    for, else those of at least the cutoff, or the best k without one."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        block = cell["block"].iloc[0]
        parts = [pd.DataFrame({"query": q, "row": r, "block": block, "part": p}) for q, r, p in _answer(cell, k, blocks, asking)]
        return pd.concat(parts) if parts else pd.DataFrame({"query": [], "row": [], "block": [], "part": []}).astype("int64")

    return cells.groupBy("block", "down", "across").applyInPandas(run, "query long, row long, block int, part long")


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The best k of each query, ties to the smaller id; tasks keep k each."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, blocks: int = 2) -> DataFrame:
    """Each query's k best other vectors: query_id, rank (from 1), vec_id, score.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on
    vec_id. Score: inner product of the scaled whole numbers, ties to the
    smaller vec_id; shorter vectors count as ending in zeros. A query with
    fewer candidates returns them all. Rows with a null vec_id, a null vector
    or a component null or not finite take no part. All rows with the query's
    vec_id count as its own. Repeated rows are candidates of their own, and a
    repeated query row returns its result again. Other columns are ignored.
    """
    ids = vectors.select(F.col("vec_id").cast("long").alias("id"), is_query.alias("asks"), scaled(F.col("embedding")).alias("vector"))
    ids = ids.where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    rows = stored(ids.withColumn("row", F.monotonically_increasing_id()), "vectors")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    per_block = -(-width // blocks)
    rows = rows.select("row", "id", "asks", F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.slice("vector", b * per_block + 1, F.lit(per_block))).alias("blocks"))
    queries = rows.where("asks").select(F.col("row").alias("query"), "id", "blocks")

    gathered = _partial_scores(_cells(queries, rows, blocks), k, blocks)
    per_node = Window.partitionBy("query", "block").orderBy(F.desc("part"), "row")
    lists = gathered.withColumn("place", F.row_number().over(per_node)).where(F.col("place") <= k)
    first = stored(lists.select("query", "row").distinct(), "lists")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    exact = _partial_scores(_cells(queries, rows, blocks, asks=first.select("query", "row", every)), k, blocks, asking=True)
    names = rows.select("row", "id")
    sums = exact.groupBy("query", "row").agg(F.sum("part").alias("score")).join(names, "row")
    # With fewer than k other rows there is no cutoff: all of them are wanted.
    cutoffs = stored(_best(sums, k).groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).alias("cutoff")), "cutoffs")

    seen = stored(_partial_scores(_cells(queries, rows, blocks, cutoffs=cutoffs), k, blocks), "entries")
    known = seen.groupBy("query", "row").agg(F.sum("part").alias("score"), F.collect_set("block").alias("told"))
    missing = known.select("query", "row", F.explode(F.array_except(F.sequence(F.lit(0), F.lit(blocks - 1)), "told")).alias("block"))
    rest = _partial_scores(_cells(queries, rows, blocks, asks=missing), k, blocks, asking=True)
    total = seen.unionByName(rest).groupBy("query", "row").agg(F.sum("part").alias("score")).join(names, "row")
    asked = queries.select("query", F.col("id").alias("query_id"))
    return _best(total, k).join(asked, "query").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")

