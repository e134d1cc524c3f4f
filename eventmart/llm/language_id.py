"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in the tasks and adds them up over a shuffle; the matrix of log
probabilities (buckets x languages) is broadcast.  Scoring hashes a batch of texts at once into a sparse
row layout (offsets, bucket indices) and multiplies it with the matrix in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, share

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Bound of the training sample: about so many labelled rows per language, chosen by a hash of doc_id.
TRAINING_ROWS = 4000
#: Code points that are hashed at once.
_SLICE = 1 << 19


def _folded() -> np.ndarray:
    """Per code point: its lower-case letter, or a space if it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _grams(points: np.ndarray, orders: tuple[int, ...], buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each order the bucket of every n-gram of the code points; runs of spaces count as they are."""
    shift = np.uint32(32 - buckets.bit_length() + 1)
    mixed = np.zeros(len(points), np.uint32)
    for n in range(1, max(orders) + 1):
        if len(points) < n:
            return
        m = len(points) - n + 1
        mixed = (mixed[:m] * np.uint32(0x01000193)) ^ (points[n - 1 :] + np.uint32(n))
        if n in orders:
            yield n, (mixed * np.uint32(0x9E3779B1)) >> shift


def _pieces(texts: list[bytes], longest: int, folded: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts as folded code points: points, start of each text there, its number.

    A text starts and ends with a space.  One over _SLICE is cut into pieces that overlap by
    ``longest - 1`` code points, so that no n-gram is lost; those within the overlap count once more.
    """
    pending, numbers, size = [], [], 0
    space = np.full(1, 32, np.uint32)
    for i, text in enumerate(texts):
        points = folded[np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
        for at in range(0, max(1, len(points)), _SLICE):
            own = points[max(0, at - longest + 1) : at + _SLICE]
            pending += [space, own, space]
            numbers.append(i)
            size += len(own) + 2
            if size >= _SLICE:
                yield _joined(pending, numbers)
                pending, numbers, size = [], [], 0
    if pending:
        yield _joined(pending, numbers)


def _within(n: int, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams of joined texts lie within one text, and how many each text has."""
    inside = np.ones(size - n + 1, bool)
    for back in range(1, n):
        at = starts[1:] - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    return inside, np.maximum(np.diff(np.append(starts, size)) - n + 1, 0)


def _joined(pending: list[np.ndarray], numbers: list[int]):
    lengths = np.array([len(pending[i]) + 2 for i in range(1, len(pending), 3)])
    return np.concatenate(pending), np.cumsum(lengths) - lengths, np.array(numbers)


def _counter(orders: tuple[int, ...], buckets: int, folded):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            texts = as_bytes(batch.column(1))
            for label in set(labels):
                own = [texts[i] for i in np.flatnonzero(labels == label)]
                into = totals.setdefault(label, np.zeros(buckets, np.int64))
                for points, starts, _ in _pieces(own, max(orders), folded()):
                    for n, grams in _grams(points, orders, buckets):
                        inside, _ = _within(n, starts, len(points))
                        into += np.bincount(grams[inside], minlength=buckets)
        for label, counts in totals.items():
            used = np.flatnonzero(counts)
            yield pa.record_batch(
                [pa.array([label] * len(used), pa.string()), pa.array(used), pa.array(counts[used])],
                names=["label", "bucket", "n"],
            )

    return count


@dataclass
class Model:
    """Languages in alphabetical order and log P(bucket | language), log P(language)."""

    languages: list[str]
    weights: np.ndarray
    prior: np.ndarray
    orders: tuple[int, ...]


def held_out() -> Column:
    """Rows no model may learn from: crc32 of doc_id as text, mod 4, is 2; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(
    labelled: DataFrame, orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS, rows: int = TRAINING_ROWS
) -> Model:
    """Fit on ``doc_id, text, lang`` rows; those without text or language are left out.

    Learns from at most about ``rows`` rows per language, those with the least hash of doc_id, with their
    whole texts.  The driver receives languages x buckets numbers at most.
    """
    usable = labelled.select("doc_id", "text", F.col("lang").alias("label")).filter("text is not null and label is not null")
    sizes = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((buckets, 0), np.float32), np.zeros(0, np.float32), orders)
    drawn_share = F.create_map(*[F.lit(x) for label in languages for x in (label, min(1.0, rows / sizes[label]))])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(drawn_share, F.col("label")) * (1 << 20)
    counted = usable.filter(drawn).select("label", "text").mapInArrow(
        _counter(orders, buckets, share(labelled.sparkSession, _folded())), "label string, bucket long, n long"
    )
    found = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((buckets, len(languages)), 0.1)
    place = {label: i for i, label in enumerate(languages)}
    columns = [place[x] for x in found.column("label").to_pylist()]
    counts[found.column("bucket").to_numpy(), columns] += found.column("n").to_numpy()
    weights = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    prior = np.log(np.array([sizes[x] for x in languages]) / sum(sizes.values())).astype(np.float32)
    return Model(languages, weights, prior, orders)


def _scores(model: Model, folded: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Log joint probability of every text (rows) with every language."""
    total = np.tile(model.prior.astype(np.float64), (len(texts), 1))
    buckets = len(model.weights)
    for points, starts, numbers in _pieces(texts, max(model.orders), folded):
        for n, grams in _grams(points, model.orders, buckets):
            inside, counts = _within(n, starts, len(points))
            grams, some = grams[inside], counts > 0
            begins = (np.cumsum(counts) - counts)[some]
            for k in range(len(model.languages) if len(begins) else 0):
                # doubles first: reduceat converts in buffers, whose edges would change the order of adding
                sums = np.add.reduceat(model.weights[:, k][grams].astype(np.float64), begins)
                np.add.at(total[:, k], numbers[some], sums)
    return total


def _has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict_udf(spark, model: Model):
    """Column function: text to ``struct<lang, score>``."""
    shared = share(spark, (model, _folded()))

    @F.arrow_udf("lang string, score double")
    def predict(column: pa.Array) -> pa.Array:
        model, folded = shared()
        texts = as_bytes(column)
        lettered = [i for i, t in enumerate(texts) if t and model.languages and _has_letter(t)]
        lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
        if lettered:
            joint = _scores(model, folded, [texts[i] for i in lettered])
            best = joint.argmax(axis=1)
            share = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
            lang[lettered] = np.array(model.languages, object)[best]
            score[lettered] = share
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], names=["lang", "score"])

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (probability of that language) for every row.

    ``und`` with score 0 for a text that is null or has no letter, or if the model knows no language; of
    languages that tie, the alphabetically first.  Repeated rows stay, other columns are not looked at,
    texts of any length are used whole.
    """
    found = docs.select("doc_id", held_out().alias("held_out"), predict_udf(docs.sparkSession, model)("text").alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows whose text has a language with at least probability ``least``; all columns as they were."""
    predict = predict_udf(docs.sparkSession, model).asNondeterministic()  # so that it runs once per row
    marked = docs.withColumn("__language", predict("text"))
    return marked.filter((F.col("__language.lang") != "und") & (F.col("__language.score") >= least)).drop("__language")
