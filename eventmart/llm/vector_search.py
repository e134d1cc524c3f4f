"""Exact top-k by inner product with bounds from segment statistics at several resolutions.

A vector is cut into segments; from a segment's mean and deviation, squared distance is at least
``sum(size * ((mean - mean')^2 + (dev - dev')^2))``, and since the inner product is
``(|q|^2 + |x|^2 - distance^2) / 2`` a lower bound on the distance is an upper bound on the score.  Bounds
are taken coarse to fine; only candidates that can still reach the k-th best exact score found so far are
refined, and the survivors are scored exactly.

Vectors are dealt into blocks and move once; queries are copied to every block and streamed through it, so a
task holds one block and one batch of queries whatever the size of the tables.  Block results (k per query and
block) meet in a window per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 1024
#: Rows of a block of vectors at most (and components, on average), and queries that are scored together.
VECTOR_BLOCK = 16_384
BLOCK_VALUES = 1 << 22
QUERY_BLOCK = 512
#: Rows of a block at least while there are no more blocks than shuffle partitions.
LEAST_BLOCK = 1_024
RESOLUTIONS = (4, 16)
_EXACT = float(1 << 52)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of equal segments, scaled so that a dot product bounds the inner product."""
    cuts = np.linspace(0, rows.shape[1], min(segments, rows.shape[1]) + 1).astype(int)[:-1]
    sizes = np.diff(np.concatenate((cuts, [rows.shape[1]])))
    means = np.add.reduceat(rows, cuts, axis=1) / sizes
    squares = np.add.reduceat(rows * rows, cuts, axis=1) / sizes
    deviations = np.sqrt(np.maximum(squares - means * means, 0))
    return np.concatenate((means, deviations), axis=1) * np.tile(np.sqrt(sizes), 2)


def _ceilings(queries: np.ndarray, vectors: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Upper bounds of scores; slack covers rounding."""
    return queries @ vectors.T + slack[:, None]


class Block:
    """Vectors of one length with their statistics."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, resolutions=RESOLUTIONS):
        order = np.argsort(ids, kind="stable")
        self.rows, self.ids, self.whole = rows[order], ids[order], vectors[order]
        self.floats = self.whole.astype(np.float64)
        self.most = np.abs(self.floats).max(initial=0)
        self.longest = (self.floats * self.floats).sum(axis=1).max(initial=0)
        self.resolutions = resolutions if vectors.shape[1] else ()
        self.levels = [_statistics(self.floats, r) for r in self.resolutions]

    def best(self, q_rows: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, list[int]]]:
        """For each query row the places and scores of its ``k`` best vectors of the block, itself left out."""
        q = queries.astype(np.float64)
        if np.abs(q).max(initial=0) * self.most * max(1, q.shape[1]) >= _EXACT:
            yield from self._best_of_any_size(q_rows, queries, k)
            return
        slack = 1 + 1e-9 * np.sqrt((q * q).sum(axis=1) * self.longest)
        levels = [_statistics(q, r) for r in self.resolutions]
        coarse = _ceilings(levels[0], self.levels[0], slack) if levels else np.zeros((len(q), len(self.ids)))
        for i in range(len(q)):
            own = self.rows != q_rows[i]
            best = min(k, int(own.sum()))
            if not best:
                yield np.zeros(0, np.int64), []
                continue
            ceiling = np.where(own, coarse[i], -np.inf)
            tried = np.argpartition(-ceiling, best - 1)[:best]
            floor = (self.floats[tried] @ q[i]).min()
            left = np.flatnonzero((ceiling >= floor) & own)
            for q_level, v_level in zip(levels[1:], self.levels[1:], strict=True):
                left = left[v_level[left] @ q_level[i] + slack[i] >= floor]
            scores = self.floats[left] @ q[i]
            ranked = np.lexsort((self.ids[left], -scores))[:best]
            yield left[ranked], [int(s) for s in scores[ranked]]

    def _best_of_any_size(self, q_rows, queries, k):
        """Whole numbers of any size; no bounds, as their rounding would have to be bounded too."""
        vectors = self.whole.astype(object)
        for row, query in zip(q_rows, queries.astype(object), strict=True):
            places = np.flatnonzero(self.rows != row)
            scores = [min(_MOST, max(_LEAST, int(s))) for s in vectors[places] @ query]
            ranked = sorted(range(len(places)), key=lambda j: (-scores[j], self.ids[places[j]]))[:k]
            yield places[ranked], [scores[j] for j in ranked]


_FOUND = "row long, query long, vec_id long, score long"


def _scan(k: int, query_block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (dim, block, asked, row, vec_id, x) sorted by block, vectors before queries, to each query's best per block."""
    key, block, held = None, None, []
    for batch in batches:
        dims, numbers, asked, rows, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(dims):
            continue
        cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(numbers) != 0) | (asked[1:] != asked[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dims)], strict=True):
            here = (int(dims[a]), int(numbers[a]))
            if here != key:
                key, block, held = here, None, []
            x = batch.column(5).slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(b - a, key[0])
            if not asked[a]:
                held.append((rows[a:b], ids[a:b], x))
                continue
            if block is None:
                if not held:
                    continue
                block, held = Block(*map(np.concatenate, zip(*held, strict=True))), []
            for at in range(0, b - a, query_block):
                part = slice(at, min(at + query_block, b - a))
                names, queries, found, scores = [], [], [np.zeros(0, np.int64)], []
                for row, name, (places, own) in zip(
                    rows[a:b][part], ids[a:b][part], block.best(rows[a:b][part], x[part], k), strict=True
                ):
                    names.append(np.full(len(places), row, np.int64))
                    queries.append(np.full(len(places), name, np.int64))
                    found.append(block.ids[places])
                    scores += own
                columns = [np.concatenate(names), np.concatenate(queries), np.concatenate(found), np.array(scores, np.int64)]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["row", "query", "vec_id", "score"])


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = SCALE,
    vector_block: int = VECTOR_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(vec_id, embedding)`` to query, rank (from 1), vec_id, score: the k best other rows for each query row.

    ``is_query`` is a condition on vec_id.  Components become ``floor(scale * x)``; the score is their integer inner
    product, ties go to the lesser vec_id.  A vector that is null, holds a null or non-finite component or has no id
    takes no part; only vectors of a query's own length are its candidates.  Every row stands for itself: rows that
    repeat an id are asked and found one by one, and a query row finds all rows but itself.  Whole components and
    scores beyond a long count as the long nearest to them.  Tables without usable rows give none.
    """
    spark = vectors.sparkSession
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    kept = vectors.filter("vec_id is not null and embedding is not null").filter(F.coalesce(finite, F.lit(False)))
    whole = kept.select(F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c * scale)).alias("x"))
    numbered = whole.withColumns({"dim": F.size("x"), "row": F.monotonically_increasing_id(), "asked": F.coalesce(is_query, F.lit(False))})
    candidates = stage(numbered, "vectors")
    n, values = candidates.agg(F.count(F.lit(1)), F.coalesce(F.sum("dim"), F.lit(0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n // vector_block), -(-values // BLOCK_VALUES), min(partitions, -(-n // LEAST_BLOCK)))

    held = candidates.withColumns({"block": F.pmod(F.xxhash64("row"), F.lit(blocks)), "asked": F.lit(False)})
    sent = candidates.filter("asked").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    columns = ["dim", "block", "asked", "row", "vec_id", "x"]
    rows = held.select(*columns).unionByName(sent.select(*columns))
    # blocks are dealt in turn, so that no task gets many while others get none
    placed = rows.repartitionById(min(blocks, partitions), F.pmod("block", F.lit(min(blocks, partitions))).cast("int"))
    met = placed.sortWithinPartitions(*columns[:4]).mapInArrow(partial(_scan, k, query_block), _FOUND)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query", "rank", "vec_id", "score")
