"""Hard negatives by BOND: a vertical scan with branch-and-bound on the scores of partly read vectors.

Vectors are dealt into blocks, each turned into columns, one per dimension, with the column's least and greatest
value.  An anchor reads the columns in descending magnitude of its own components.  What the unread columns can still
add at most and at least bounds every candidate's score; candidates whose bounds leave every wanted window, or that
as many surer ones outrank, are cleared from the bitmap, and only the remaining ones are read on.  After the last
column the scores are exact.

The scan runs twice: for an anchor's positives (rows of its label, one window without ends), then for the windows of
scores that its positives open among the rows of other labels.  Both times vectors move once; anchors are copied to
the blocks and streamed through them, so a task holds one block and a batch of anchors whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least this share of the positive's, as a fraction, and at most the positive's.
LEAST_SHARE = (4, 5)
#: Components of a block at most, and at least unless there are fewer; between them, blocks are as many as shuffle partitions.
BLOCK_MOST, BLOCK_LEAST = 1 << 22, 1 << 16
#: Columns read between two looks at the bounds.
STEP = 8
_EXACT = float(1 << 52)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


class Block:
    """Vectors of one length as columns."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.rows, self.ids, self.labels = rows[order], ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.most = float(np.abs(vectors.astype(np.float64)).max(initial=0))
        self.floats = self.columns.astype(np.float64)
        self.ends = (self.floats.min(axis=1), self.floats.max(axis=1))
        self._whole = None

    def read(self, anchor: np.ndarray):
        """Anchor, columns and their ends as numbers whose sums of products are exact, and whether sums can pass a long."""
        if self.most * float(np.abs(anchor.astype(np.float64)).max(initial=0)) * max(1, len(anchor)) < _EXACT:
            return anchor.astype(np.float64), self.floats, self.ends, False
        if self._whole is None:
            whole = self.columns.astype(object)
            self._whole = whole, (whole.min(axis=1), whole.max(axis=1))
        return anchor.astype(object), *self._whole, True

    def scan(self, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple], k: int) -> list[tuple[np.ndarray, list]]:
        """For each window of scores (ends included, None for none): the places and scores of the ``k`` best of ``wanted``."""
        own, columns, (least, most), wide = self.read(anchor)
        order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
        ends = np.stack((own * least, own * most))[:, order]
        rest = [np.concatenate((np.cumsum(e[::-1])[::-1], [0])) for e in (ends.max(axis=0), ends.min(axis=0))] if len(own) else [[0], [0]]
        left = np.flatnonzero(wanted)
        score = np.zeros(len(left), own.dtype)
        bounded = (lambda x: np.clip(x, _LEAST, _MOST)) if wide else (lambda x: x)
        for at in range(0, len(own), STEP):
            if not len(left):
                break
            read = order[at : at + STEP]
            score = score + own[read] @ columns[np.ix_(read, left)]
            done = at + len(read)
            upper, lower = bounded(score + rest[0][done]), bounded(score + rest[1][done])
            alive = np.zeros(len(left), bool)
            for low, high in windows:
                above = np.ones(len(left), bool) if low is None else upper >= low
                below = np.ones(len(left), bool) if high is None else lower <= high
                sure = lower[(True if low is None else lower >= low) & (np.ones(len(left), bool) if high is None else upper <= high)]
                if len(sure) > k:
                    above &= upper >= np.partition(sure, len(sure) - k)[len(sure) - k]
                alive |= above & below
            left, score = left[alive], score[alive]
        score, found = bounded(score), []
        for low, high in windows:
            inside = np.ones(len(left), bool)
            if low is not None:
                inside &= score >= low
            if high is not None:
                inside &= score <= high
            places = np.flatnonzero(inside)
            best = places[np.lexsort((self.ids[left[places]], -score[places]))[:k]] if not wide else np.array(
                sorted(places.tolist(), key=lambda i: (-score[i], self.ids[left[i]]))[:k], np.int64
            )
            found.append((left[best], [int(s) for s in score[best]]))
        return found


_FOUND = "row long, window int, vec_id long, score long"


def _scan_blocks(k: int, own_label: bool):
    """Rows sorted by block, vectors before anchors, to each anchor's best per window and block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_key, block, held = None, None, []
        for batch in batches:
            dims, numbers, kinds, rows, ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            vectors, floors = batch.column(6), batch.column(7)
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            out = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dims)], strict=True):
                if a == b:
                    continue
                key = (int(dims[a]), int(numbers[a]))
                if key != block_key:
                    block_key, block, held = key, None, []
                stacked = vectors.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(b - a, key[0])
                if kinds[a] == 0:
                    held.append((rows[a:b], ids[a:b], labels[a:b], stacked))
                    continue
                if block is None:
                    if not held:
                        continue
                    block, held = Block(*[np.concatenate(c) for c in zip(*held, strict=True)]), []
                for i in range(b - a):
                    same = block.labels == labels[a + i]
                    wanted = same & (block.rows != rows[a + i]) if own_label else ~same
                    windows = [(None, None)]
                    if not own_label:
                        over, under = LEAST_SHARE
                        windows = [(-(-over * p // under), p) for p in floors[a + i].as_py()]
                    for w, (places, scores) in enumerate(block.scan(stacked[i], wanted, windows, k)):
                        out.extend((int(rows[a + i]), w, int(block.ids[p]), s) for p, s in zip(places, scores, strict=True))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds_out = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds_out, strict=True)], names=["row", "window", "vec_id", "score"])

    return scan


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, x (whole numbers) and dim of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    kept = vectors.filter("vec_id is not null and label is not null and embedding is not null").filter(finite)
    whole = kept.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform(x, lambda c: F.floor(c * scale)).alias("x")
    )
    return whole.withColumn("dim", F.size("x"))


def _scanned(rows: DataFrame, anchors: DataFrame, blocks: int, k: int, own_label: bool) -> DataFrame:
    """The ``k`` best per anchor and window over all blocks, with rank."""
    columns = ["row", "vec_id", "label", "x", "floors"]
    held = rows.select("dim", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), *columns[:-1], F.lit(None).cast("array<long>").alias("floors"))
    numbers = F.sequence(F.lit(0), F.lit(blocks - 1))
    read = anchors.select("dim", F.explode(numbers).alias("block"), F.lit(1).alias("kind"), *columns)
    dealt = held.unionByName(read).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind", "row")
    found = dealt.mapInArrow(_scan_blocks(k, own_label), _FOUND)
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """For every anchor and positive the best negatives: anchor_id, positive_id, rank, negative_id and both scores.

    ``vectors`` are vec_id, label, embedding; ``is_anchor`` is a condition on vec_id and label.  Components become
    ``floor(scale * x)``; a score is the integer inner product with the anchor, higher ones first, ties by lesser vec_id.
    Positives are the first ``positives`` other rows of the anchor's label, negatives the first rows of other labels
    that score from 80 to 100 % of the positive.  A row takes no part if its id, label or vector is null or a component
    is null or not finite; vectors are compared with those of their own length only.  Every row stands for itself:
    rows that repeat an id are candidates (and, as anchors, asked) one by one.  Whole components and scores beyond a
    long count as the long nearest to them.  Other columns are not looked at; without anchors there are no rows.
    """
    spark = vectors.sparkSession
    numbered = usable(vectors, scale).withColumn("anchor", F.coalesce(is_anchor, F.lit(False)))
    rows = stage(numbered.withColumn("row", F.monotonically_increasing_id()), "vectors")
    values = rows.agg(F.sum("dim")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-values // BLOCK_MOST), min(-(-values // BLOCK_LEAST), partitions))
    anchors = rows.filter("anchor")
    none = anchors.withColumn("floors", F.lit(None).cast("array<long>"))
    near = stage(_scanned(rows, none, blocks, positives, True).select("row", F.col("vec_id").alias("positive_id"), "score"), "positives")
    # equal scores open one window; a positive below zero opens none
    floors = near.filter("score >= 0").groupBy("row").agg(F.sort_array(F.collect_set("score")).alias("floors"))
    opened = anchors.join(floors, "row")
    found = stage(_scanned(rows, opened, blocks, negatives, False), "negatives")
    asked = near.join(opened.select("row", F.col("vec_id").alias("anchor_id"), "floors"), "row")
    asked = asked.filter("score >= 0").withColumn("window", (F.array_position("floors", F.col("score")) - 1).cast("int"))
    hard = found.select("row", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return asked.join(hard, ["row", "window"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )
