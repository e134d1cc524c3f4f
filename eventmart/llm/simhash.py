"""Near-duplicate documents by SimHash and an inverted index over byte positions.

Fingerprints of 64 bits that differ in at most ``distance`` bits share at least ``8 - distance`` of
their 8 bytes.  The index posts every fingerprint under each choice of that many byte positions with
their values; a posting list thus holds only fingerprints that already share the guaranteed number of
bytes.  Within a list, the shared bytes of a pair are tallied, the pair is taken up in the first list
that holds it, and its distance is verified.  Long lists (near copies of one text) yield a spanning
forest instead of all their pairs, and very long ones are cut into blocks whose pairs go to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, salted_join, stage
from .components import connected_components

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
#: Fingerprints of a posting list that one task compares among each other.
BLOCK = 4096
#: Lists up to this length are compared pair by pair in one go.
SHORT = 64
_SLICE = 1 << 16


def fingerprint(data: bytes, size: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text as an unsigned number; 0 for a text without words."""
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(size, len(words)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        hashes = b"".join(
            [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _SLICE], ends[at : at + _SLICE], strict=True)]
        )
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprint_udf(size: int = SHINGLE_WORDS):
    """Column function: a text's fingerprint as a signed long; a null text has no words."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(
            np.array([fingerprint(t or b"", size) for t in as_bytes(texts)], np.uint64).view(np.int64)
        )

    return of


def _choices(shared: int) -> list[tuple[int, ...]]:
    return list(combinations(range(8), shared))


def _first_choice(shared: int) -> np.ndarray:
    """For each set of equal bytes (bit i: byte i) the first list that holds such a pair; -1: too few."""
    table = np.full(256, -1, np.int64)
    for mask in range(256):
        for i, chosen in enumerate(_choices(shared)):
            if all(mask >> p & 1 for p in chosen):
                table[mask] = i
                break
    return table


def _post(prints: DataFrame, shared: int) -> DataFrame:
    """A row per fingerprint and choice of byte positions: choice, the bytes there, fingerprint."""
    masks = [sum(0xFF << (8 * p) for p in chosen) for chosen in _choices(shared)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    lists = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask")) for i, m in enumerate(signed)])
    posted = prints.select("fp", F.explode(lists).alias("at"))
    return posted.select(F.col("at.choice").alias("choice"), F.col("fp").bitwiseAND(F.col("at.mask")).alias("part"), "fp")


def _forest(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what any links within the distance connect, one fewer than nodes at most."""
    rest, left, right = prints, [], []
    while len(rest) > 1:
        grown, rest = [rest[0]], rest[1:]
        while grown and len(rest):
            at = grown.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                new = rest[near]
                left.append(np.full(len(new), at))
                right.append(new)
                grown.extend(new)
                rest = rest[~near]
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _short_lists(choice, part, fp, length, distance, first):
    """All links within lists of up to SHORT fingerprints; each pair only in the first list that has it."""
    left, right = [], []
    at = np.arange(len(fp))
    for step in range(1, SHORT):
        at = at[at + step < len(fp)]
        at = at[(part[at + step] == part[at]) & (choice[at + step] == choice[at]) & (length[at] <= SHORT)]
        if not len(at):
            break
        x = fp[at] ^ fp[at + step]
        equal = np.packbits(x.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0]
        keep = (first[equal] == choice[at]) & (np.bitwise_count(x) <= distance)
        left.append(fp[at[keep]])
        right.append(fp[at[keep] + step])
    return left, right


_LINKS = "choice long, part long, block long, a long, b long"


def _table(choice, part, block, a, b) -> pa.RecordBatch:
    columns = [np.asarray(x) for x in (choice, part, block, a, b)]
    columns = [x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64) for x in columns]
    return pa.record_batch([pa.array(x) for x in columns], names=["choice", "part", "block", "a", "b"])


def _links_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = np.full(len(a), -1)
    return _table(none, none, none, a, b)


def _scan_lists(distance: int, shared: int, block: int):
    """Sorted postings to links (block -1); members of lists over ``block`` come out again, numbered by block."""
    first = _first_choice(shared)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        hot, done = None, 0  # key of the long list being passed on, blocks of it so far

        def passed_on(key, fps):
            nonlocal done
            for at in range(0, len(fps), block):
                own = fps[at : at + block]
                n = len(own)
                yield _table(np.full(n, key[0]), np.full(n, key[1]), np.full(n, done), own, np.zeros(n))
                done += 1

        def whole(choice, part, fp):
            """Complete lists."""
            cuts = np.flatnonzero(np.diff(part).astype(bool) | np.diff(choice).astype(bool)) + 1
            starts = np.concatenate(([0], cuts))
            lengths = np.diff(np.concatenate((starts, [len(fp)])))
            left, right = _short_lists(choice, part, fp, np.repeat(lengths, lengths), distance, first)
            for at, n in zip(starts[lengths > SHORT].tolist(), lengths[lengths > SHORT].tolist(), strict=True):
                a, b = _forest(fp[at : at + n], distance)
                left.append(a)
                right.append(b)
            if sum(map(len, left)):
                yield _links_of(np.concatenate(left), np.concatenate(right))

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
            choice, part, fp = (np.concatenate(x) for x in zip(held, [*new[:2], new[2].view(np.uint64)], strict=True))
            if not len(fp):
                continue
            if hot is not None:
                same = (choice == hot[0]) & (part == hot[1])
                n = int(same.sum())
                if n == len(fp):
                    keep = n % block
                    yield from passed_on(hot, fp[: n - keep])
                    held = [x[n - keep :] for x in (choice, part, fp)]
                    continue
                yield from passed_on(hot, fp[:n])
                hot, (choice, part, fp) = None, (x[n:] for x in (choice, part, fp))
            others = np.flatnonzero((choice != choice[-1]) | (part != part[-1]))
            last = int(others[-1]) + 1 if len(others) else 0  # the list after it may go on in the next batch
            # long lists inside the complete part
            cuts = np.flatnonzero(np.diff(part[:last]).astype(bool) | np.diff(choice[:last]).astype(bool)) + 1
            starts = np.concatenate(([0], cuts)) if last else np.zeros(0, np.int64)
            lengths = np.diff(np.concatenate((starts, [last]))) if last else np.zeros(0, np.int64)
            normal = np.ones(last, bool)
            for at, n in zip(starts[lengths > block].tolist(), lengths[lengths > block].tolist(), strict=True):
                done = 0
                yield from passed_on((choice[at], part[at]), fp[at : at + n])
                normal[at : at + n] = False
            if normal.any():
                yield from whole(choice[:last][normal], part[:last][normal], fp[:last][normal])
            held = [x[last:] for x in (choice, part, fp)]
            if len(held[2]) > block:
                hot, done = (held[0][0], held[1][0]), 0
                n = len(held[2]) - len(held[2]) % block
                yield from passed_on(hot, held[2][:n])
                held = [x[n:] for x in held]
        if len(held[2]):
            if hot is not None:
                yield from passed_on(hot, held[2])
            else:
                yield from whole(*held)

    return scan


def _scan_cells(distance: int):
    """Sorted members of cells (two blocks of one list each) to links."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            new = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
            rows = np.concatenate([*held, new], axis=1)
            if not rows.shape[1]:
                continue
            cuts = np.flatnonzero((np.diff(rows[:4], axis=1) != 0).any(axis=0)) + 1
            bounds = np.concatenate(([0], cuts))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield _links_of(*_forest(rows[4, a:b].view(np.uint64), distance))
            held = [rows[:, bounds[-1] :]]
        if held:
            yield _links_of(*_forest(np.ascontiguousarray(held[0][4]).view(np.uint64), distance))

    return scan


def links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Distinct ``fp`` longs to ``(a, b)`` links that connect what links within ``distance`` connect."""
    shared = 8 - distance
    if not 1 <= shared <= 8:
        raise ValueError("distance must be 0 to 7")
    postings = _post(prints, shared)
    dealt = postings.repartition("choice", "part").sortWithinPartitions("choice", "part", "fp")
    found = stage(dealt.mapInArrow(_scan_lists(distance, shared, block), _LINKS), "links")
    members = found.filter("block >= 0").select("choice", "part", "block", F.col("a").alias("fp"))
    blocks = members.groupBy("choice", "part").agg(F.max("block").alias("last"))
    cells = (
        salted_join(members, blocks, ["choice", "part"], F.col("block"), "inner")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .select(
            "choice", "part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp"
        )
    )
    keys = ["choice", "part", "i", "j"]
    across = cells.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(_scan_cells(distance), _LINKS)
    return found.filter("block < 0").select("a", "b").unionByName(across.select("a", "b")).distinct()


def groups(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """``(doc_id, fp)`` rows to one row per fingerprint: fp, root (of its component), component_id."""
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = connected_components(links(nodes.select("fp"), distance, block))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return salted_join(rooted, least, ["root"], F.xxhash64("fp"), "inner").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, block: int = BLOCK
) -> DataFrame:
    """Every row's fingerprint and component: doc_id, fingerprint (hex), component_id (least doc_id).

    A null or empty text has fingerprint zero and is linked like any other.  Repeated rows stay.  A null
    doc_id keeps its row but never names a component unless all its ids are null.  Other columns are not
    looked at.  An empty table gives no rows.
    """
    prints = docs.select("doc_id", fingerprint_udf(size)("text").alias("fp"))
    prints = stage(prints, "fingerprints")
    found = salted_join(prints, groups(prints, distance, block), ["fp"], F.xxhash64("doc_id"), "inner")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Of each component only the row with the least doc_id (of repeated rows, one), all columns as they were."""
    row = F.xxhash64("doc_id", "text")
    prints = stage(docs.select("doc_id", row.alias("row"), fingerprint_udf(size)("text").alias("fp")), "fingerprints")
    found = salted_join(prints, groups(prints, distance), ["fp"], F.col("row"), "inner")
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("row").alias("__row"))
    kept = docs.withColumn("__row", row).join(first.select("__row"), "__row").dropDuplicates(["__row"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
