"""I-Match fingerprints: hashes of a document's terms within several randomised subsets of a lexicon.

Terms are runs of ASCII letters, digits and any other code points, A-Z lower-cased.  The lexicon holds the terms
of a band of inverse document frequency: those in at least ``LEAST_DOCS`` documents and in at most the share
``MOST_SHARE`` of all.  Document frequencies cover every document; they are counted per term hash of ``BUCKET_BITS``
bits, so that what is broadcast is a bitmap of fixed size (2 MB) however many terms there are.

A randomised subset (level, i) keeps a term with a chance of 2 ** -level, decided by the term's hash.  A signature is
the hash of the document's distinct terms in a subset, sorted.  One changed term alters the signatures of the subsets
that hold it, so subsets must be small beside the document: its level is the logarithm of its number of terms, and it
is signed in all subsets of that level and the next, in which one or two, and about one, of its terms are kept.
Documents are compared at the levels they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, share, stage, text_key

#: The band: a term of the lexicon is in so many documents at least, and in this share of them at most.
LEAST_DOCS, MOST_SHARE = 2, 0.1
#: A document of whose distinct terms the lexicon holds less than this share is fingerprinted by all its terms.
LEAST_COVERED = 0.25
#: Bits of the term hashes by which document frequencies are counted.
BUCKET_BITS = 24
#: Randomised subsets of a level.
SUBSETS = 16
SEED = 42
_PAGE_BITS = 15
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _KEPT else 32 for c in range(256))
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, SUBSETS, np.uint64) * np.uint64(2) + np.uint64(1)
_NONE = "-"


def terms(data: bytes) -> np.ndarray:
    """Sorted distinct hashes of a text's terms."""
    own = set(data.translate(_TERMS).split())
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(w, SEED) for w in own), np.uint64, len(own)))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class Lexicon:
    """A bit per bucket of term hashes: whether its terms are in the band."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def chosen(self, hashes: np.ndarray) -> np.ndarray:
        """The terms that count: those in the band, or all if too few are."""
        at = _buckets(hashes)
        inside = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return hashes if inside.sum() < LEAST_COVERED * len(hashes) else hashes[inside == 1]

    def fingerprint(self, data: bytes) -> str:
        """Level and signatures; ``-`` for a text without terms."""
        own = self.chosen(terms(data))
        if not len(own):
            return _NONE
        level = len(own).bit_length() - 1
        out = [f"{level:02x}"]
        mixed = own[:, None] ^ (own[:, None] >> np.uint64(31))
        mixed = mixed * _ODD
        mixed ^= mixed >> np.uint64(29)
        mixed = mixed * _ODD[::-1]
        for depth in (level, level + 1):
            kept = mixed >> np.uint64(64 - depth) == 0 if depth else np.ones_like(mixed, bool)
            for i in range(SUBSETS):
                inside = own[kept[:, i]]
                out.append(f"{max(1, xxhash.xxh32_intdigest(inside.tobytes(), i)) if len(inside) else 0:08x}")
        return "".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal signatures among those of shared levels that are of some term of either; 1 if all is equal."""
    if a == b:
        return 1.0
    if _NONE in (a, b):
        return 0.0
    size, levels = 8 * SUBSETS, (int(a[:2], 16), int(b[:2], 16))
    same = signed = 0
    for level in range(max(levels), min(levels) + 2):
        x, y = (s[2 + (level - own) * size :][:size] for s, own in zip((a, b), levels, strict=True))
        for i in range(0, size, 8):
            if x[i : i + 8] != "00000000" or y[i : i + 8] != "00000000":
                signed += 1
                same += x[i : i + 8] == y[i : i + 8]
    return same / signed if signed else 0.0


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_buckets(terms(t or b"")) for t in as_bytes(batch.column(0))]
        own = np.concatenate([np.unique(b) for b in found]) if found else np.zeros(0, np.int64)
        bucket, n = np.unique(own, return_counts=True)
        yield pa.record_batch([pa.array(bucket), pa.array(n.astype(np.int64))], names=["bucket", "n"])


def learn_lexicon(docs: DataFrame, least_docs: int = LEAST_DOCS, most_share: float = MOST_SHARE) -> Lexicon:
    """The band of the documents' terms, from all of them.  What comes to the driver is the bitmap, at most."""
    counts = docs.select("text").mapInArrow(_count_buckets, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    most = most_share * docs.count()
    band = counts.filter(F.col("n").between(F.lit(least_docs), F.lit(max(most, float(least_docs)))))
    page = F.shiftright("bucket", _PAGE_BITS)
    place = F.col("bucket").bitwiseAND(F.lit((1 << _PAGE_BITS) - 1))
    pages = stage(band.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(place).alias("bits")), "lexicon")
    bits = np.zeros(1 << (BUCKET_BITS - 3), np.uint8)
    size = 1 << (_PAGE_BITS - 3)
    for row in pages.toLocalIterator():
        bits[row["page"] * size : (row["page"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return Lexicon(bits)


def fingerprints(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All rows and columns, with ``fingerprint`` (a column of that name is replaced).  A null text is an empty one."""
    shared = share(docs.sparkSession, lexicon)

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        own = shared()
        return pa.array([own.fingerprint(t or b"") for t in as_bytes(texts)], pa.string())

    return docs.withColumn("fingerprint", of("text"))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the text that follows."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


_DIGITS = ("edited_sha256", "fingerprint", "edited_fingerprint")
#: Results as tasks give them: hexadecimal digits as bytes, none for the fingerprint of no terms.
_RESULT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_FIELDS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.binary()) for n in _DIGITS]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_ENDS = [("part", pa.int32()), ("first", pa.bool_()), ("text", pa.string())]


def _packed(fingerprint: str) -> bytes:
    return b"" if fingerprint == _NONE else bytes.fromhex(fingerprint)


def _compared(lexicon: Lexicon, doc_id, text: str, own: str, following: str, other: str) -> tuple:
    changed = edited(text, following).encode()
    after = lexicon.fingerprint(changed)
    sha = hashlib.sha256(changed).digest()
    return doc_id, len(text), sha, _packed(own), _packed(after), likeness(own, after), likeness(own, other)


def _chain(shared):
    """Sorted ``doc_id, text`` to results of every row but a task's last; that and the first are given with their texts."""
    kinds = pa.schema([*_FIELDS, *_ENDS])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, part, held = shared(), TaskContext.get().partitionId(), None

        def end(first: bool) -> tuple:
            doc_id, text, own = held
            return doc_id, len(text), None, _packed(own), None, None, None, part, first, text

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                now = (doc_id, text or "", lexicon.fingerprint((text or "").encode()))
                if held is None:
                    held = now
                    out.append(end(True))
                else:
                    out.append((*_compared(lexicon, *held, *now[1:]), part, None, None))
                held = now
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(_turned(out, kinds), kinds, strict=True)], schema=kinds)
        if held is not None:
            last = [end(False)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(_turned(last, kinds), kinds, strict=True)], schema=kinds)

    return chain


def _turned(rows: list[tuple], kinds: pa.Schema) -> list:
    return list(zip(*rows, strict=True)) or [()] * len(kinds)


def _join_ends(shared):
    """``doc_id, text`` of a task's last row and ``text`` of the row after it to results."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared()
        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns], strict=True)
            pairs = [(i, a, lexicon.fingerprint(a.encode()), b, lexicon.fingerprint(b.encode())) for i, a, b in rows]
            out = _turned([_compared(lexicon, *pair) for pair in pairs], _FIELDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FIELDS, strict=True)], schema=_FIELDS)

    return finish


def compare_in_order(docs: DataFrame, lexicon: Lexicon, order: Column | None = None) -> DataFrame:
    """For every row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one after it by doc_id (null first; rows of one doc_id by the hash of their text, rows
    alike in both in any order), after the last the first, so a sole document follows itself.  The edited text has the
    last quarter of the code points replaced by the first as many (or all) of the next one's.  ``near_*`` are the
    likeness of the row's fingerprint to the edited text's and the next document's.  A null text is an empty one; texts
    without terms have the fingerprint ``-``, alike to themselves only.  Other columns are not looked at; an empty
    table gives no rows.

    Rows are sorted by range, so each task holds a stretch of the order and reads it once, with one document in hand;
    only a task's first and last texts are written and meet in a join.
    """
    spark = docs.sparkSession
    shared = share(spark, lexicon)
    rows = docs.select(F.col("doc_id").cast("long"), "text", text_key().alias("hash"), F.monotonically_increasing_id().alias("nth"))
    dealt = rows.repartitionByRange("doc_id", "hash", "nth").sortWithinPartitions("doc_id", "hash", "nth")
    ends = "part int, first boolean, text string"
    found = stage(dealt.select("doc_id", "text").mapInArrow(_chain(shared), f"{_RESULT}, {ends}"), "fingerprints")
    names = [f.name for f in _FIELDS]
    firsts = found.filter("first")
    parts = sorted(r["part"] for r in firsts.select("part").collect())  # a number per task
    follows = list(zip(parts, parts[1:] + parts[:1], strict=True))
    after = spark.createDataFrame(follows, "part int, after int")
    heads = firsts.select(F.col("part").alias("after"), F.col("text").alias("next_text"))
    tails = found.filter("not first").join(after, "part").join(heads, "after")
    last = tails.select("doc_id", "text", "next_text").mapInArrow(_join_ends(shared), _RESULT)
    whole = found.filter("first is null").select(*names).unionByName(last)
    digits = {c: F.when(F.length(c) > 0, F.lower(F.hex(c))).otherwise(_NONE) for c in _DIGITS}
    return whole.withColumns(digits)
