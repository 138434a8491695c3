"""Exact top-k inner products: tiles of queries against all vectors, merged as a tree.

Queries are dealt into tiles of bounded size; a tile is broadcast and meets every
partition of the vectors in blocks by a matrix product. Each block's scores are cut to
the best of each query by partial selection, together with the best so far, so a
partition sends k rows per query. A tile's lists are written and its broadcast released
before the next tile is made. The partitions' lists are merged as a tree: a round brings
FAN_IN of a query's lists together and keeps the best of them.

Components become floor(scale * x) as whole numbers, so scores are exact as long as
they stay below 2**53, which is checked. Vectors that are null, or hold null or
non-finite components, take no part, and an empty vector scores 0. A query's own rows
(same id) are no candidates. Ties go to the smaller id. Of a query that occurs in
several rows the smallest vector counts; candidate rows that repeat an id count once
with their best score. Vectors of different lengths have no product and are no
candidates of each other. No vectors, or no queries, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

#: Queries that are broadcast at once.
TILE = 4096
#: Vectors of a block; tile and block bound the scores held at once.
BLOCK = 1024
#: Lists of a query that a round of merging brings together.
FAN_IN = 16
_NONE = -(1 << 62)


def _whole(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, vector) with whole-numbered vectors of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    floored = F.transform(vector, lambda x: F.floor(x * scale).cast("double"))
    chosen = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), vector_column)
    chosen = chosen.where(F.col("vec_id").isNotNull() & F.col(vector_column).isNotNull() & ~bad)
    return chosen.select("vec_id", floored.alias("vector"))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each length."""
    begins = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(begins)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[begins[rows][:, None] + np.arange(size)]


def _tile(candidates: DataFrame, queries: list[tuple[int, list[float]]], best: int) -> DataFrame:
    """Per partition (``part``) and query of the tile, its ``best`` candidates, written."""
    lengths = {}
    for vec_id, vector in queries:
        lengths.setdefault(len(vector), []).append((vec_id, vector))
    tiles = {
        size: (np.array([i for i, _ in own], np.int64), np.array([v for _, v in own], np.float64).reshape(len(own), size))
        for size, own in lengths.items()
    }
    shared = candidates.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {size: _Lists(len(ids), best) for size, (ids, _) in shared.value.items()}
        for batch in batches:
            vec_ids = batch.column(0).to_numpy()
            for rows, vectors in _by_length(batch.column(1)):
                if vectors.shape[1] not in lists:
                    continue
                own_ids, own = shared.value[vectors.shape[1]]
                for i in range(0, len(rows), BLOCK):
                    block, block_ids = vectors[i : i + BLOCK], vec_ids[rows[i : i + BLOCK]]
                    if np.abs(block).sum(axis=1).max(initial=0) * np.abs(own).max(initial=0) >= 1 << 53:
                        raise ValueError("scores beyond exact whole numbers")
                    scores = (own @ block.T).astype(np.int64)
                    scores[own_ids[:, None] == block_ids[None, :]] = _NONE
                    lists[vectors.shape[1]].offer(scores, block_ids)
        for size, (own_ids, _) in shared.value.items():
            rows, places = np.nonzero(lists[size].top > _NONE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own_ids[rows]), pa.array(lists[size].who[rows, places]), pa.array(lists[size].top[rows, places]),
                    pa.array(np.full(len(rows), TaskContext.get().partitionId(), np.int64)),
                ],
                names=["query_id", "vec_id", "score", "part"],
            )

    found = store.written(candidates.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint, part bigint"), "tile")
    shared.unpersist()
    return found


def _kept(lists: DataFrame, best: int, *lists_by: str) -> DataFrame:
    """The ``best`` of each list after merging, with their rank; an id that repeats counts once, with its best score."""
    once = Window.partitionBy("query_id", *lists_by, "vec_id").orderBy(F.desc("score"))
    ranked = Window.partitionBy("query_id", *lists_by).orderBy(F.desc("score"), "vec_id")
    # Placed by the list, both windows need no further shuffle.
    placed = lists.repartition("query_id", *lists_by).withColumn("_n", F.row_number().over(once)).where(F.col("_n") == 1)
    return placed.drop("_n").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= best)


def merged(lists: DataFrame, best: int, parts: int) -> DataFrame:
    """One list per query of those of ``parts`` partitions, by rounds that merge FAN_IN lists at a time."""
    while parts > FAN_IN:
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN))
        lists = _kept(lists, best, "part").drop("rank")
        parts = -(-parts // FAN_IN)
    return _kept(lists, best)


class _Lists:
    """The best candidates of each query so far, sorted, ties by id."""

    def __init__(self, queries: int, best: int):
        self.top = np.full((queries, best), _NONE, np.int64)
        self.who = np.full((queries, best), np.iinfo(np.int64).max)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        best = self.top.shape[1]
        # An id may stand in several rows of a block, so each one counts once before selection.
        if len(np.unique(ids)) < len(ids):
            order = np.argsort(ids, kind="stable")
            begins = np.flatnonzero(np.concatenate([[True], ids[order][1:] != ids[order][:-1]]))
            scores, ids = np.maximum.reduceat(scores[:, order], begins, axis=1), ids[order][begins]
        least = self.top[:, -1:]
        if scores.shape[1] > best:
            least = np.maximum(least, np.partition(scores, -best, axis=1)[:, -best, None])
        rows, columns = np.nonzero((scores >= least) & (scores > _NONE))
        if len(rows):
            _merge(self.top, self.who, rows, scores[rows, columns], ids[columns])


def _merge(top: np.ndarray, who: np.ndarray, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
    """Put new candidates into the sorted lists of their rows; an id stays once, with its best score."""
    best = top.shape[1]
    touched = np.unique(rows)
    held = np.repeat(touched, best)
    all_rows = np.concatenate([rows, held])
    all_scores = np.concatenate([scores, top[touched].ravel()])
    all_ids = np.concatenate([ids, who[touched].ravel()])
    order = np.lexsort((-all_scores, all_ids, all_rows))
    r, s, v = all_rows[order], all_scores[order], all_ids[order]
    once = np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1]) | (s[1:] == _NONE)])
    r, s, v = r[once], s[once], v[once]
    order = np.lexsort((v, -s, r))
    r, s, v = r[order], s[order], v[order]
    begin = np.searchsorted(r, touched)
    end = np.searchsorted(r, touched, "right")
    for j in range(best):
        at = begin + j
        there = at < end
        top[touched, j] = np.where(there, s[np.minimum(at, len(s) - 1)], _NONE)
        who[touched, j] = np.where(there, v[np.minimum(at, len(v) - 1)], np.iinfo(np.int64).max)


def top_k(
    vectors: DataFrame, is_query: Column, best: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding", tile: int = TILE
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's best candidates among all other rows."""
    spark = vectors.sparkSession
    store.ship(spark)
    whole = _whole(vectors, id_column, vector_column, scale)
    queries = whole.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    tiles = max(1, -(-queries.count() // tile))
    if tiles > 1:
        queries = store.written(queries.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles))), "queries")
    lists = []
    for k in range(tiles):
        rows = (queries if tiles == 1 else queries.where(F.col("tile") == k)).select("vec_id", "vector").collect()
        lists.append(_tile(whole, [(r["vec_id"], r["vector"]) for r in rows], best))
    found = reduce(DataFrame.unionByName, lists)
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    return merged(found, best, parts).select("query_id", "rank", "vec_id", "score")
