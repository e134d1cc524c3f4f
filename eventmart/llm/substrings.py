"""Repeated passages: words inside a window that already started earlier in the corpus.

Comparing all documents with automata of all documents would grow with the square of the corpus, so
automata are built of what can repeat only, and sent to where it is read:

1. Every window picks as its anchor the gram of ``GRAM`` words with the least hash in it, so equal windows
   pick equal grams at the same offset.  Consecutive windows with one anchor form a slice.
2. Slices are counted by anchor and content; an anchor that occurs once holds no repeated window.
3. Anchors with several distinct slices are the reference shards: their slices, in corpus order, are
   streamed through the shard's suffix automaton, and a matching length of a whole window marks that
   window as started earlier.  A slice with something new is added to the automaton.
4. Every later occurrence of a slice is repeated as a whole.  Marked windows are gathered per document
   and cut out.

A shard with more than ``SHARD_SLICES`` distinct slices (a common line in ever new surroundings) is split: its slices
are cut again, by the two grams with the least hashes in a window instead of one, then by four and so on.  Equal windows
still meet, since they pick equal grams; with all grams of a window, only equal windows do.  Equal slices are counted
once at every level, and what occurs once goes before any join, so shards shrink until automata decide all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import as_bytes, salted_join, stage

WINDOW = 20
GRAM = 5
SHARD_SLICES = 1000
#: A slice's place is its first word's number times _ROOM plus its number of windows.
_ROOM = 64
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** n, modulo 2 ** 64."""
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def slices_of(words: list[bytes], window: int, gram: int, level: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slices of a text: first window, number of windows, hash of the anchor, hash of anchor place and words.

    At a higher ``level``, the anchor is made of that many grams, those with the least hashes.
    """
    n, span = len(words), window - gram + 1
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)
    grams = np.zeros(n - gram + 1, np.uint64)
    for i in range(gram):
        grams = grams * np.uint64(_BASE) + hashes[i : n - gram + 1 + i]
    grams = _mixed(grams)
    windows = np.lib.stride_tricks.sliding_window_view(grams, span)
    if level == 1:
        key = windows.min(axis=1)
        anchor = np.zeros(len(key), np.int64)
        for i in range(span - 1, -1, -1):  # the first of equal ones
            np.copyto(anchor, np.arange(i, i + len(key)), where=grams[i : i + len(key)] == key)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
    else:
        least = np.argsort(windows, axis=1, kind="stable")[:, :level]
        places = least + np.arange(len(windows))[:, None]
        key = np.full(len(windows), level, np.uint64)
        for column in np.take_along_axis(windows, least, axis=1).T:
            key = _mixed(key * np.uint64(_BASE) + column)
        anchor, places = places[:, 0], np.sort(places, axis=1)
        first = np.flatnonzero(np.concatenate(([True], (np.diff(places, axis=0) != 0).any(axis=1))))
    count = np.diff(np.concatenate((first, [len(anchor)])))
    powers, back = _powers(_BASE, n), _powers(_INVERSE, n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1])))
    content = (sums[first + count + window - 1] - sums[first]) * back[first]
    offset = (anchor[first] - first).astype(np.uint64)
    content = _mixed(content + offset * np.uint64(_ROOM) + count.astype(np.uint64))
    return first, count, key[first], content


_SLICES = "doc_id long, row long, place long, anchor long, content long"


def _cut_slices(window: int, gram: int):
    """``doc_id, row, text`` to the slices of every text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts = [], []
            for text in as_bytes(batch.column(2)):
                first, count, anchor, content = slices_of((text or b"").split(), window, gram)
                parts.append((first * _ROOM + count, anchor.view(np.int64), content.view(np.int64)))
                counts.append(len(first))
            if parts:
                which = pa.array(np.repeat(np.arange(len(counts)), counts))
                columns = [batch.column(0).take(which), batch.column(1).take(which)]
                columns += [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.record_batch(columns, names=["doc_id", "row", "place", "anchor", "content"])

    return cut


#: A slice of a shard: which distinct slice it is a part of and from which window on; first word, shard, content, words.
_PART = [("anchor", pa.int64()), ("content", pa.int64()), ("number", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64())]
_PART += [("row", pa.int64()), ("shard", pa.int64()), ("part", pa.int64()), ("words", pa.binary())]
_PARTS = "anchor long, content long, number int, doc_id long, start long, row long, shard long, part long, words binary"


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_PART)
    return pa.record_batch([pa.array(c, k) for c, (_, k) in zip(columns, _PART, strict=True)], names=[n for n, _ in _PART])


def _read_references(window: int):
    """Words of wanted slices; the shard is the anchor."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, rows, wanted = (batch.column(i).to_pylist() for i in (0, 1, 3))
            out = []
            for doc_id, row, text, wants in zip(doc_ids, rows, as_bytes(batch.column(2)), wanted, strict=True):
                words = text.split()
                for want in wants:
                    first, count = divmod(want["place"], _ROOM)
                    own = b" ".join(words[first : first + count + window - 1])
                    out.append((want["anchor"], want["content"], 0, doc_id, first, row, want["anchor"], want["content"], own))
            yield _parts(out)

    return read


def _cut_again(window: int, gram: int, level: int):
    """Slices of shards that are too large to slices of smaller ones."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, content, number, doc_id, start, row, _, _, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = text.split()
                first, count, shard, part = slices_of(words, window, gram, level)
                found = zip(first.tolist(), count.tolist(), shard.view(np.int64).tolist(), part.view(np.int64).tolist(), strict=True)
                for at, n, key, own in found:
                    out.append((anchor, content, number + at, doc_id, start + at, row, key, own, b" ".join(words[at : at + n + window - 1])))
            yield _parts(out)

    return cut


def _match_shards(window: int):
    """Slices sorted by shard and corpus order to the windows of each (bits) that started earlier."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, SuffixAutomaton()
        for batch in batches:
            shards, numbers, texts = (batch.column(i).to_pylist() for i in (0, 3, 4))
            masks = []
            for own, number, text in zip(shards, numbers, texts, strict=True):
                if own != shard:
                    shard, automaton = own, SuffixAutomaton()
                words = text.split()
                state = matched = mask = 0
                for i, word in enumerate(words):
                    state, matched = automaton.step(state, matched, word)
                    if matched >= window:
                        mask |= 1 << (i + 1 - window)
                if mask.bit_count() < len(words) - window + 1:
                    automaton.add(words)
                masks.append(mask << number)
            yield pa.record_batch(
                [batch.column(1), batch.column(2), pa.array(masks, pa.int64())], names=["anchor", "content", "mask"]
            )

    return match


def _order(at: Column) -> Column:
    """Which of equal windows counts as the first: by document, then start; the hash splits rows of one doc_id."""
    return F.struct("doc_id", at.alias("at"), "row")


def _started_earlier(rows: DataFrame, slices: DataFrame, window: int, gram: int, shard_slices: int) -> DataFrame:
    """For slices of anchors that have several: anchor, content, mask of the windows that started earlier."""
    want = F.struct("anchor", "content", F.col("first.at").alias("place"))
    wanted = slices.filter("several > 1").groupBy(F.col("first.row").alias("row")).agg(F.collect_list(want).alias("wanted"))
    texts = rows.join(wanted, "row").dropDuplicates(["row"]).select("doc_id", "row", "text", "wanted")
    parts = stage(texts.mapInArrow(_read_references(window), _PARTS), "references")
    sizes = slices.filter("several > 1").select(F.col("anchor").alias("shard"), F.col("several").alias("n")).distinct()
    ready, repeated, level, span = [], [], 1, window - gram + 1
    while True:
        too_large = stage(sizes.filter((F.col("n") > shard_slices) & F.lit(level < span)).select("shard"), "large")
        if not too_large.head(1):
            ready.append(parts)
            break
        ready.append(parts.join(too_large, "shard", "left_anti"))
        level = min(2 * level, span)
        rest = parts.join(too_large, "shard", "left_semi").select(*[n for n, _ in _PART])
        cut = stage(rest.mapInArrow(_cut_again(window, gram, level), _PARTS), "cut")
        place = F.struct("doc_id", "start", "row")
        firsts = stage(cut.groupBy("shard", "part").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("equal")), "firsts")
        sizes = stage(firsts.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "sizes")
        # of equal slices the first one is compared, the others started earlier as a whole; what is alone goes
        again = cut.join(firsts.filter("equal > 1").drop("equal"), ["shard", "part"]).filter(place > F.col("first"))
        windows = F.size(F.split(F.col("words").cast("string"), " ")) - (window - 1)
        repeated.append(again.select("anchor", "content", "number", windows.alias("windows")))
        kept = cut.join(firsts.join(sizes.filter("n > 1").select("shard"), "shard").drop("equal"), ["shard", "part"])
        parts = stage(kept.filter(place == F.col("first")).select(*[n for n, _ in _PART]), "parts")
    shards = ready[0]
    for other in ready[1:]:
        shards = shards.unionByName(other)
    shards = shards.repartition("shard").sortWithinPartitions("shard", "doc_id", "start", "row")
    masks = shards.select("shard", "anchor", "content", "number", "words").mapInArrow(
        _match_shards(window), "anchor long, content long, mask long"
    )
    for again in repeated:
        whole = F.expr("shiftleft(shiftleft(1L, windows) - 1L, number)")
        masks = masks.unionByName(again.select("anchor", "content", whole.alias("mask")))
    return masks.groupBy("anchor", "content").agg(F.bit_or("mask").alias("mask"))


def _stretches(rows: DataFrame, window: int, gram: int, shard_slices: int) -> DataFrame:
    """``doc_id, row, text`` to row and its repeated stretches, coded like places (first word, windows)."""
    cut = stage(rows.mapInArrow(_cut_slices(window, gram), _SLICES), "slices")
    counts = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    again = stage(salted_join(cut, counts, ["anchor"], F.col("row"), "inner", 4), "again", drop=(cut,))
    slices = again.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min(_order(F.col("place"))).alias("first"))
    slices = stage(slices, "distinct")
    several = slices.groupBy("anchor").agg(F.count(F.lit(1)).alias("several"))
    slices = stage(salted_join(slices, several, ["anchor"], F.col("content"), "inner", 4), "shards", drop=(slices,))
    earlier = _started_earlier(rows, slices, window, gram, shard_slices)
    marked = slices.join(earlier, ["anchor", "content"], "left").withColumn("mask", F.coalesce("mask", F.lit(0)))
    marked = marked.filter("n > 1 or mask != 0").select("anchor", "content", "first", "mask")
    bits = F.filter(F.sequence(F.lit(0), F.col("place") % _ROOM - 1), lambda i: F.getbit("mask", i.cast("int")) == 1)
    whole_bits = F.transform(bits, lambda i: (F.floor(F.col("place") / _ROOM) + i) * _ROOM + 1)
    own = F.when(_order(F.col("place")) == F.col("first"), whole_bits).otherwise(F.array("place"))
    found = salted_join(again, marked, ["anchor", "content"], F.col("row"), "inner", 4).select("row", own.alias("own"))
    return found.filter(F.size("own") > 0).groupBy("row").agg(F.flatten(F.collect_set("own")).alias("stretches"))


def _keep(window: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, stretches in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = (text or b"").split()
                n = len(words)
                if stretches:
                    first, count = np.divmod(np.array(stretches), _ROOM)
                    marks = np.zeros(n + 1, np.int64)
                    np.add.at(marks, first, 1)
                    np.add.at(marks, first + count + window - 1, -1)
                    left = np.cumsum(marks[:n]) == 0
                    words = [words[i] for i in np.flatnonzero(left).tolist()]
                n_words.append(n)
                n_removed.append(n - len(words))
                kept.append(b" ".join(words))
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
            yield pa.record_batch(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    return keep


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_slices: int = SHARD_SLICES
) -> DataFrame:
    """For every row: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A word goes if some window of ``window`` words over it has the same words as one that starts earlier: in
    a lesser doc_id (null before all others), or earlier in the same document.  Windows are judged on the
    texts as they came.  A null text has no words.  Rows alike in doc_id and text are one document and stay
    alike; rows that share a doc_id but not the text count as parts of one document, and of windows that
    start at the same word of both, the one with the lesser hash of its row is the earlier.  Other columns
    are not looked at; an empty table gives no rows.
    """
    if not 1 <= gram <= window < gram + _ROOM - 2:
        raise ValueError("gram must be up to window, and window - gram below 62")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row"), "text")
    found = stage(_stretches(rows, window, gram, shard_slices), "stretches")
    joined = salted_join(rows, found, ["row"], F.monotonically_increasing_id(), "left", 4)
    return joined.select("doc_id", "text", "stretches").mapInArrow(
        _keep(window), "doc_id long, n_words long, n_removed long, kept string"
    )
