"""Near copies by the Jaccard similarity of five-word shingles, found by SimHash and an inverted index over byte positions.

A text's SimHash has ``WORDS`` words of 64 bits.  As in op2 it is posted under choices of its byte positions with the bytes
there, here ``BANDS`` pairs of positions; candidates share a posting list.  Two texts at 0.8 differ in about 15 % of the
bits, so they share no list with a chance of about 0.0003.  The first ``_WORDS`` words also give the distance of the texts
of a list: short lists give every pair within ``FAR`` bits; longer ones give the texts that have another within ``FAR``
bits, and those under the first ``EARLY`` choices also a minimum spanning forest, which
at every distance connects what all pairs within that distance connect, with fewer links than texts.
Lists over ``BLOCK`` are cut into blocks whose pairs go to many tasks.  Every pair found is then compared
shingle by shingle, so that a link is never wrong; the hashed shingles of a text that is in any pair or long list are
computed and written once.  The bits are an estimate, and a tree edge that fails the comparison
may have stood for one that would not; so each long list that still holds more than one group gets the shingles of its
texts, and the task that has it compares every text outside its largest group to all of other groups within ``FAR``
bits.  Only links leave that task, fewer than the list has texts, so no two texts of a list within ``FAR`` bits stay
apart uncompared although their pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NUMBER_ROWS, as_bytes, salted_join, stage, text_key
from .components import connected_components

SHINGLE_WORDS = 5
#: Least similarity of a link, as a fraction.
SIMILARITY = (4, 5)
#: Words of 64 bits of a SimHash, and pairs of its byte positions that it is posted under.
WORDS, BANDS = 16, 128
#: Bits of the first 128 in which candidates may differ; two texts at 0.8 differ in about 19 of them (deviation 4).
FAR = 37
#: Lists up to this length give all their pairs.
SHORT = 10
#: Pairs of byte positions, of BANDS, whose longer lists give links to start from.
EARLY = 16
#: Texts of a list that one task compares among each other.
BLOCK = 2048
SEED = 42
#: Pairs per text for which one copy of the text is sent.
_PAIRS_A_COPY = 64
#: Pairs that a task hands on at a time.
_PAIRS_OUT = 1 << 16
#: Shingles whose bits are counted in one byte each.
_SLICE = 255
_WORDS = 2
_RNG = np.random.default_rng(SEED)
_ODD = _RNG.integers(0, 1 << 63, (2, WORDS), np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.concatenate([_RNG.permutation(8 * WORDS).reshape(-1, 2) for _ in range(BANDS // (4 * WORDS))])


def shingles(data: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of a UTF-8 text's shingles; a shorter text is one shingle, one without words has none."""
    words = data.lower().split()
    n = max(1, len(words) - size + 1) if words else 0
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + size]), SEED) for i in range(n)), np.uint64, n))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a Jaccard similarity of SIMILARITY or more; two empty ones have."""
    most, least = max(len(a), len(b)), min(len(a), len(b))
    over, under = SIMILARITY
    if least * under < most * over:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * under >= (len(a) + len(b) - both) * over


def simhash(own: np.ndarray) -> np.ndarray:
    """Words of the SimHash of a set of shingles."""
    counts = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(own), _SLICE):
        part = own[at : at + _SLICE]
        bits = (part[:, None] ^ (part[:, None] >> np.uint64(29))) * _ODD[0]
        bits = (bits ^ (bits >> np.uint64(32))) * _ODD[1]
        bits ^= bits >> np.uint64(29)
        counts += np.unpackbits(bits.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(own)).view(np.uint64)


def places(prints: np.ndarray) -> np.ndarray:
    """The posting lists of rows of words: number of the pair of byte positions, then the bytes there."""
    found = prints.view(np.uint8).reshape(len(prints), 8 * WORDS)[:, _PLACES].astype(np.uint64)
    return (np.arange(BANDS, dtype=np.uint64) << np.uint64(16)) | (found[..., 0] << np.uint64(8)) | found[..., 1]


def sketch(own: np.ndarray) -> np.ndarray:
    """Posting lists, then the words that distances are taken of, of a set of shingles."""
    words = simhash(own)
    return np.concatenate((places(words[None])[0], words[:_WORDS]))


_BITS = [f"s{i}" for i in range(_WORDS)]


def _simhash_udf():
    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(shingles(t or b"")).tobytes() for t in as_bytes(texts)], pa.binary())

    return of


def _places_udf():
    @F.arrow_udf("array<long>")
    def of(prints: pa.Array) -> pa.Array:
        words = np.frombuffer(b"".join(prints.to_pylist()), np.uint64).reshape(len(prints), WORDS)
        offsets = pa.array(np.arange(len(prints) + 1, dtype=np.int32) * BANDS)
        return pa.ListArray.from_arrays(offsets, pa.array(places(words).view(np.int64).ravel()))

    return of


def _bits_udf():
    @F.arrow_udf(", ".join(f"{c} long" for c in _BITS))
    def of(prints: pa.Array) -> pa.Array:
        words = np.frombuffer(b"".join(prints.to_pylist()), np.int64).reshape(len(prints), WORDS)
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(words[:, i])) for i in range(_WORDS)], names=_BITS)

    return of


def _shingles_udf():
    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(t or b"").tobytes() for t in as_bytes(texts)], pa.binary())

    return of


def _similar_udf():
    @F.arrow_udf("boolean")
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left, right, strict=True)  # sets are looked at where they lie
        sets = ([np.frombuffer(x.as_buffer(), np.uint64) for x in pair] for pair in pairs)
        return pa.array([similar(a, b) for a, b in sets], pa.bool_())

    return of


def _all_pairs(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.triu_indices(len(bits), 1)
    near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) <= FAR
    return a[near], b[near]


def spanning_forest(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum spanning forest over the pairs within FAR bits, by Prim's method."""
    n = len(bits)
    best, parent, rest = np.full(n, FAR + 1, np.int64), np.zeros(n, np.int64), np.arange(n)
    left, right, at = [], [], 0
    rest = rest[1:]
    while len(rest):
        near = np.bitwise_count(bits[rest] ^ bits[at]).sum(axis=1, dtype=np.int64)
        closer = near < best[rest]
        best[rest[closer]], parent[rest[closer]] = near[closer], at
        i = int(best[rest].argmin())
        at = int(rest[i])
        if best[at] <= FAR:
            left.append(parent[at])
            right.append(at)
        rest = np.delete(rest, i)
    return np.array(left, np.int64), np.array(right, np.int64)


def _first_pairs(band: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs to be compared; of a longer list also the texts within FAR bits of another, each as a pair with itself."""
    if len(bits) <= SHORT:
        yield _all_pairs(bits)
        return
    x, y = spanning_forest(bits)
    if band[0] < EARLY:
        yield x, y
    near = np.union1d(x, y)
    yield near, near


def _more_pairs(nearest: int, root: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    _, group, sizes = np.unique(root, return_inverse=True, return_counts=True)
    if len(sizes) > 1:
        for at in np.flatnonzero(group != sizes.argmax()):
            near = np.bitwise_count(bits ^ bits[at]).sum(axis=1, dtype=np.int64)
            others = np.flatnonzero((near <= FAR) & (group != group[at]))
            own = others[np.argsort(near[others], kind="stable")[:nearest]]
            yield np.full(len(own), at), own


_CELL = ["key", "i", "j"]


def _scan(find, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells (key, i, j, node, band or root, bits), sorted, to pairs with their cell, some _PAIRS_OUT at a time."""

    def pairs(rows: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        cell, left, right, n = [], [], [], 0
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            node, bits = rows[a:b, 3], np.ascontiguousarray(rows[a:b, 5:]).view(np.uint64)
            for x, y in find(rows[a:b, 4], bits):
                cell.append(np.repeat(rows[a : a + 1, :3], len(x), axis=0))
                left.append(np.minimum(node[x], node[y]))
                right.append(np.maximum(node[x], node[y]))
                n += len(x)
                if n >= _PAIRS_OUT:
                    yield batch_of(cell, left, right)
                    cell, left, right, n = [], [], [], 0
        if n:
            yield batch_of(cell, left, right)

    def batch_of(cell: list[np.ndarray], left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
        columns = [*np.concatenate(cell).T, np.concatenate(left), np.concatenate(right)]
        return pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=[*_CELL, "a", "b"])

    held: list[np.ndarray] = []
    for batch in batches:
        new = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        if not len(new):
            continue
        if held and (held[0][-1, :3] == new[-1, :3]).all():  # still the same cell
            held.append(new)
            continue
        rows = np.concatenate([*held, new])
        bounds = np.concatenate(([0], np.flatnonzero((np.diff(rows[:, :3], axis=0) != 0).any(axis=1)) + 1))
        yield from pairs(rows, bounds)
        held = [rows[bounds[-1] :]]
    if held:
        rows = np.concatenate(held)
        yield from pairs(rows, np.array([0, len(rows)]))


def candidates(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``node, print`` rows to ``key, i, j, a, b``: pairs to be compared, and where a is b, the texts of long lists
    that have another within reach, each with its cell (a list, or two blocks of it)."""
    told = nodes.select("node", _bits_udf()("print").alias("s"), _places_udf()("print").alias("keys"))
    postings = told.select("node", "s.*", F.explode("keys").alias("key"))
    hot = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    hot = stage(hot.select("key", F.ceil(F.col("n") / block).alias("blocks")), "hot")
    cut = salted_join(postings, hot, ["key"], F.xxhash64("node"), "left") if hot.head(1) else postings.withColumn("blocks", F.lit(None).cast("long"))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), blocks)
    cells = (
        cut.select("key", "node", *_BITS, own.alias("own"), blocks.alias("blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .select(*_CELL, "node", F.shiftright("key", 16).alias("band"), *_BITS)
    )
    dealt = cells.repartition(*_CELL).sortWithinPartitions(*_CELL, "node")
    return dealt.mapInArrow(partial(_scan, _first_pairs), "key long, i long, j long, a long, b long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the ``(a, b)`` pairs whose texts are similar, by their ``node, shingles`` (one row each).

    A text that is in many pairs is sent in several copies, so that its pairs go to many tasks.
    """
    ends = _ends(pairs).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    ways = stage(ends.select("node", F.ceil(F.col("n") / _PAIRS_A_COPY).alias("ways")), "ways")
    sent = sets.join(ways, "node").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)))
    for end, other in (("a", "b"), ("b", "a")):
        mine = ways.select(F.col("node").alias(end), F.col("ways").alias("__ways"))
        pairs = salted_join(pairs, mine, [end], F.xxhash64(other), "inner")
        pairs = pairs.withColumn(f"salt_{end}", F.pmod(F.xxhash64(other, F.lit(3)), F.col("__ways"))).drop("__ways")
    for end in "ab":
        pairs = pairs.join(sent.select(*[F.col(c).alias(n) for c, n in (("node", end), ("salt", f"salt_{end}"), ("shingles", f"of_{end}"))]), [end, f"salt_{end}"])
    return pairs.filter(_similar_udf()("of_a", "of_b")).select("a", "b")


def _cell_links(cell: pa.Table) -> pa.Table:
    """``node, root, bits, shingles`` of a cell to links that connect what all its pairs within FAR bits connect."""
    node, label = cell.column("node").to_numpy(), cell.column("root").to_numpy().copy()
    bits = np.stack([cell.column(c).to_numpy() for c in _BITS], axis=1).view(np.uint64)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in cell.column("shingles")]
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
    own, (over, under) = np.zeros(len(distinct), bool), SIMILARITY
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, y in _more_pairs(len(node), label.copy(), bits):
        y = y[label[y] != label[x]]  # not linked meanwhile
        if not len(y):
            continue
        at = x[0]
        mine = codes[ends[at] - sizes[at] : ends[at]]
        own[mine] = True
        seen = np.concatenate(([0], np.cumsum(own[codes])))
        own[mine] = False
        both = seen[ends[y]] - seen[ends[y] - sizes[y]]
        y = y[both * under >= (sizes[at] + sizes[y] - both) * over]
        groups, first = np.unique(label[y], return_index=True)
        label[np.isin(label, groups)] = label[at]
        left.append(np.full(len(first), node[at]))
        right.append(node[y[first]])
    return pa.table({"a": np.concatenate(left), "b": np.concatenate(right)})


def within_lists(members: DataFrame, rooted: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different groups of ``key, i, j, node`` cells; cells of one group are left out before shingles move."""
    root = rooted.select("node", "root", _bits_udf()("print").alias("s")).select("node", "root", "s.*")
    placed = stage(members.join(root, "node"), "members")
    mixed = placed.groupBy(*_CELL).agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least != most")
    open_cells = placed.join(mixed.select(*_CELL), _CELL)
    told = sets.select(F.col("node").alias("__member"), "shingles")
    whole = open_cells.join(told, F.col("node") == F.col("__member")).drop("__member")
    return whole.groupBy(*_CELL).applyInArrow(_cell_links, "a long, b long").distinct()


def _sets(ends: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, shingles`` of staged nodes, from ``row, text``; only the row that stands for a text is read."""
    wanted = ends.distinct().join(nodes, "node")
    found = texts.join(wanted.select("node", F.col("place.row").alias("row")), "row")
    return found.dropDuplicates(["node"]).select("node", _shingles_udf()("text").alias("shingles"))


def _joined(rooted: DataFrame, links: DataFrame) -> DataFrame:
    """``rooted`` after new links: their groups, not their texts, are connected, so a pass costs what it adds."""
    root = rooted.select("node", "root")
    for end in "ab":
        links = links.join(root.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end)
    found = connected_components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    found = found.select(F.col("node").alias("root"), F.col("root").alias("__new"))
    return rooted.join(found, "root", "left").withColumn("root", F.coalesce("__new", "root")).drop("__new")


def keep_one(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of each group of near copies only the row with the least doc_id (of repeated rows, one), all columns as
    they were.  A null doc_id is kept only if all ids of its group are null."""
    row = F.xxhash64("doc_id", "text")
    marked = docs.select("doc_id", row.alias("row"), text_key().alias("node"), _simhash_udf()("text").alias("print"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    nodes = stage(marked.groupBy("node").agg(F.min(place).alias("place"), F.first("print").alias("print")), "nodes")
    found = stage(candidates(nodes, block), "candidates", batch_rows=NUMBER_ROWS)
    pairs = stage(found.filter("a != b").select("a", "b").distinct(), "pairs")
    members = found.filter("a = b").select(*_CELL, F.col("a").alias("node"))
    ends = _ends(pairs).unionByName(members.select("node"))
    sets = stage(_sets(ends, nodes, docs.select(row.alias("row"), "text")), "shingles")
    rooted = nodes.join(sets.select("node"), "node").withColumn("root", F.col("node"))
    rooted = stage(_joined(rooted, stage(verified(pairs, sets), "links")), "rooted")
    rooted = stage(_joined(rooted, stage(within_lists(members, rooted, sets), "links")), "rooted")
    root = rooted.select("node", "root")
    placed = nodes.select("node", "place").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = placed.groupBy("root").agg(F.min("place").alias("place"))
    rows = docs.withColumn("__row", row).join(kept.select(F.col("place.row").alias("__row")), "__row").dropDuplicates(["__row"])
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
