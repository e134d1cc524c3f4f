"""I-Match fingerprints against a plain implementation, in document order."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from tests.conftest import SMALL

from eventmart.llm import i_match
from eventmart.llm.queries import QUERIES

_MASK = (1 << 64) - 1


def _terms(text):
    own = re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower().encode() if (text or "").isascii() else re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return sorted({xxhash.xxh64_intdigest(w, i_match.SEED) for w in own})


def _band(texts, bits=i_match.BUCKET_BITS):
    counts = {}
    for t in texts:
        for b in {h >> (64 - bits) for h in _terms(t)}:
            counts[b] = counts.get(b, 0) + 1
    most = max(i_match.MOST_SHARE * len(texts), i_match.LEAST_DOCS)
    return {b for b, n in counts.items() if i_match.LEAST_DOCS <= n <= most}


def _signatures(text, band):
    """(level, subset) to the terms in it, for both levels of a text."""
    own = _terms(text)
    inside = [h for h in own if h >> (64 - i_match.BUCKET_BITS) in band]
    own = own if len(inside) < i_match.LEAST_COVERED * len(own) else inside
    found = {}
    for level in (len(own).bit_length() - 1, len(own).bit_length()) if own else ():
        for i in range(i_match.SUBSETS):
            kept = []
            for h in own:
                x = (h ^ (h >> 31)) * int(i_match._ODD[i]) & _MASK
                x = (x ^ (x >> 29)) * int(i_match._ODD[-1 - i]) & _MASK
                if x >> (64 - level) == 0:
                    kept.append(h)
            found[level, i] = tuple(kept)
    return found


def _likeness(a, b):
    if a == b:
        return 1.0
    shared = [k for k in a if k in b and (a[k] or b[k])]
    return sum(a[k] == b[k] for k in shared) / len(shared) if shared else 0.0


def _expected(rows):
    band = _band([t for _, t in rows])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 4
        changed = text[: len(text) - cut] + after[:cut]
        own, other, following = (_signatures(t, band) for t in (text, changed, after))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), round(_likeness(own, other), 9), round(_likeness(own, following), 9)))
    return sorted(out, key=str)


def _found(df):
    rows = df.collect()
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows), key=str)


def test_query_as_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_i_match"](spark, SMALL)
    assert _found(found) == _expected(rows)
    prints = {}
    for r in found.join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        assert prints.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]


def test_edits_are_near_and_neighbours_are_not(spark):
    found = QUERIES["op11_i_match"](spark, SMALL).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in found) >= 0.9 * len(found)


def test_hard_rows(spark):
    rows = [(None, "no id"), (3, None), (1, ""), (2, "a"), (9, "! ?"), (8, "Zwölf BOXKÄMPFER jagen 𝒳 " * 9000), (7, "plain words " * 3), (4, "plain words " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash")).withColumn("part", F.lit(1))
    lexicon = i_match.learn_lexicon(docs)
    found = i_match.compare_in_order(docs.repartition(3), lexicon)
    assert _found(found) == _expected(rows)
    prints = {r["doc_id"]: r["fingerprint"] for r in found.collect()}
    assert prints[3] == prints[1] == prints[9] == "-" and prints[7] == prints[4]
    assert i_match.fingerprints(docs, lexicon).columns == ["doc_id", "text", "fingerprint", "part"]


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(i, f"text {i} of few") for i in range(n)], "doc_id long, text string")
    found = i_match.compare_in_order(docs, i_match.learn_lexicon(docs))
    assert _found(found) == _expected([tuple(r) for r in docs.collect()])


def test_repeated_rows_and_ids(spark):
    rows = [(5, "same text here")] * 40 + [(5, "another one")] + [(6, "the end of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = i_match.compare_in_order(docs, i_match.learn_lexicon(docs)).collect()
    assert len(found) == len(rows)
    assert sum(r["near_next"] == 1.0 for r in found) == 39  # each copy but the last is followed by a copy


def test_likeness_follows_changes(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    lexicon = i_match.Lexicon(i_match.np.full(1 << (i_match.BUCKET_BITS - 3), 255, i_match.np.uint8))
    own = lexicon.fingerprint(" ".join(words).encode())

    def changed(share):
        return lexicon.fingerprint(" ".join(f"x{rng.random()}" if rng.random() < share else w for w in words).encode())

    near = [sum(i_match.likeness(own, changed(s)) for _ in range(20)) / 20 for s in (0.01, 0.1, 0.3, 0.9)]
    assert near == sorted(near, reverse=True) and near[0] > 0.9 and near[-1] < 0.1
    assert i_match.likeness(own, own) == 1.0
