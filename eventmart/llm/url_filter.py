"""Host and path rules on urls, by membership of url keys in Bloom filter cascades.

A key is a host or one of its parent domains, followed by the start of a path: ``example.net/en/``.  A
url fits a rule if the rule is among its keys.  A cascade answers for a list of keys and for the complete
set of keys that the corpus has: level 0 is a Bloom filter of the listed keys, level 1 one of the other
keys that level 0 lets through, level 2 one of the listed keys that level 1 lets through, and so on until
nothing is let through wrongly.  The level at which a key is first missing then tells exactly if it is
listed, so urls are judged without a join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import share, stage

BITS_PER_KEY = 12
HASHES = 6
#: Keys of one level at most, which bounds what is broadcast (48 MB); longer lists need several cascades.
MAX_KEYS = 1 << 25
MAX_LEVELS = 50

# Rules of the query.
BLOCK_RULES = ("net/", "example.com/de/")
ALLOW_RULES = ("example.net/en/", "org/fr/")


@dataclass
class Cascade:
    """Bit arrays, one per level."""

    levels: list[np.ndarray]

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe it was built over; h1 and h2 are the keys' two hashes."""
        listed, open_ = np.zeros(len(h1), bool), np.ones(len(h1), bool)
        for i, bits in enumerate(self.levels):
            passed = np.zeros(len(h1), bool)
            passed[open_] = _test(bits, h1[open_], h2[open_], i)
            listed[open_ & ~passed] = i % 2 == 1
            open_ = passed
        listed[open_] = len(self.levels) % 2 == 1
        return listed


def _slots(size: int, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """Bit numbers of keys (rows); other ones on each level."""
    steps = np.arange(1, HASHES + 1, dtype=np.uint64) + np.uint64(level * HASHES)
    mixed = h1.view(np.uint64)[:, None] + steps * (h2.view(np.uint64)[:, None] | np.uint64(1))
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) % np.uint64(size)


def _test(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    at = _slots(len(bits) * 64, h1, h2, level)
    return ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))


def _level(keys: DataFrame, n: int, level: int) -> np.ndarray:
    """A Bloom filter: tasks set bits in words of 64, which are joined by word over a shuffle."""
    if n > MAX_KEYS:
        raise ValueError(f"{n} keys; a cascade takes {MAX_KEYS}: split the list by a hash of the key")
    words = max(1, -(-n * BITS_PER_KEY // 64))

    def bits(batches):
        for batch in batches:
            at = np.unique(_slots(words * 64, *_columns(batch), level))
            cuts = np.flatnonzero(np.diff(at >> np.uint64(6), prepend=np.uint64(1 << 63)))
            if len(at):
                values = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), cuts)
                yield pa.record_batch(
                    [pa.array((at[cuts] >> np.uint64(6)).view(np.int64)), pa.array(values.view(np.int64))],
                    names=["word", "bits"],
                )

    found = keys.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    array = np.zeros(words, np.uint64)
    array[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return array


def _passing(keys: DataFrame, array: np.ndarray, level: int) -> DataFrame:
    """Keys that a level lets through."""
    bits = share(keys.sparkSession, array)

    def passing(batches):
        for batch in batches:
            h1, h2 = _columns(batch)
            yield batch.filter(pa.array(_test(bits(), h1, h2, level)))

    return keys.mapInArrow(passing, keys.schema)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """From ``key`` tables: the listed keys, and all keys that will be asked for.

    Nulls are ignored, repeated keys count once; an empty list gives a cascade that contains nothing.  The
    driver holds the bit arrays only: 12 bits per listed key, and less for every further level.
    """
    marked = _hashed(listed.filter("key is not null")).withColumn("listed", F.lit(True)).unionByName(
        _hashed(universe.filter("key is not null")).withColumn("listed", F.lit(False))
    )
    keys = stage(marked.groupBy("h1", "h2").agg(F.max("listed").alias("listed")), "keys")
    one, other = (keys.filter(F.col("listed") == own).select("h1", "h2") for own in (True, False))
    levels: list[np.ndarray] = []
    while n := one.count():
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("two keys have both hashes in common")
        levels.append(_level(one, n, len(levels)))
        # what this level lets through wrongly is the next level's list
        one, other = stage(_passing(other, levels[-1], len(levels) - 1), "passing"), one
    return Cascade(levels)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null or a url without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    rest, pattern = F.coalesce(rest, F.lit("")), r"^([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(rest, pattern, 1), _UPPER, _LOWER), F.regexp_extract(rest, pattern, 2)


def _keys(shapes: list[tuple[int, int]], host: Column, path: Column) -> Column:
    """Keys of a url that have the shape (labels of the host, characters of the path) of some rule; longest first."""
    labels = F.size(F.split(host, r"\."))

    def key(n: int, m: int) -> Column:
        own = F.substring_index(host, ".", -n)
        text = F.concat(own, F.substring(path, 1, m))
        return F.when((labels >= n) & (F.length(path) >= m), F.struct(-F.length(text), -F.length(own), text.alias("key")))

    return F.transform(F.array_sort(F.filter(F.array(*[key(*s) for s in shapes]), lambda k: k.isNotNull())), lambda k: k.key)


def _verdict_udf(spark: SparkSession, cascades: dict[str, Cascade]):
    """Column function: the hashes of keys to the place (from 1) of the cascade that has each, or 0."""
    shared = share(spark, list(cascades.values()))

    @F.arrow_udf("array<int>")
    def lists(first: pa.Array, second: pa.Array) -> pa.Array:
        h1, h2 = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (first, second))
        found = np.zeros(len(h1), np.int32)
        for i, cascade in reversed(list(enumerate(shared(), 1))):
            found[cascade.contains(h1, h2)] = i
        lengths = np.diff(first.offsets.to_numpy())
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    return lists


def judge(pages: DataFrame, rules: dict[str, list[str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``page_id, url``.

    ``rules`` has the rules (host followed by path) of each verdict.  A rule fits its host and all
    subdomains if the path starts with the rule's.  The longest rule that fits wins; of equally long ones
    that with the longer host, and of verdicts with the same rule the first named.  Without one, rule is null and the
    verdict is ``default``.  A null url has empty host and path.  Repeated rows stay, other columns are not
    looked at, an empty table gives no rows.
    """
    spark = pages.sparkSession
    split = [(r.partition("/")[0], "/" + r.partition("/")[2] if "/" in r else "") for own in rules.values() for r in own]
    shapes = sorted({(host.count(".") + 1, len(path)) for host, path in split})
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not shapes:
        return base.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keyed = base.withColumn("keys", _keys(shapes, F.col("host"), F.col("path")))
    universe = stage(keyed.select(F.explode("keys").alias("key")).distinct(), "universe")
    cascades = {
        verdict: build_cascade(spark.createDataFrame([(r,) for r in own], "key string"), universe)
        for verdict, own in rules.items()
    }
    hashed = keyed.withColumn("h1", F.transform("keys", lambda k: F.xxhash64(k))).withColumn(
        "h2", F.transform("keys", lambda k: F.xxhash64(F.lit("second"), k))
    )
    lists = _verdict_udf(spark, cascades)("h1", "h2")
    first = F.filter(F.arrays_zip("keys", "lists"), lambda k: k.lists > 0)
    names = F.array(*[F.lit(v) for v in rules])
    found = hashed.withColumn("lists", lists).withColumn("hit", F.try_element_at(first, F.lit(1)))
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("hit.keys").alias("rule"),
        F.coalesce(F.try_element_at(names, F.col("hit.lists")), F.lit(default)).alias("verdict"),
    )
