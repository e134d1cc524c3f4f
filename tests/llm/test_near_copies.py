"""The pipeline's near copies against brute force: every pair of texts, five-word shingles, similarity 0.8."""

import random
from itertools import combinations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL

from eventmart.llm import near_copies


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _changed(words, share, rng):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


@pytest.fixture(scope="module")
def copies(spark):
    """Texts with near copies of 0.2 to 3 % changed words, and one group of 120 of a single text."""
    rng = random.Random(5)
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()
    own = sorted({r["text"] for r in rows if r["text"] and 40 <= len(r["text"].split()) <= 400})[:50]
    texts = [*own, *[_changed(t.split(), share, rng) for t in own for share in (0.002, 0.01, 0.02, 0.03)]]
    words = [f"word{rng.randrange(3000)}" for _ in range(250)]
    texts += [_changed(words, 0.012, rng) for _ in range(120)]
    texts += [texts[0], texts[0], "one two", "One  two", ""]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.fixture(scope="module")
def linked(copies):
    sets = {i: _shingles(t) for i, t in copies.items()}
    return {(a, b) for a, b in combinations(copies, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}


def _kept(copies, links):
    root = {i: i for i in copies}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return sorted(i for i in copies if root[i] == i)


def _frame(spark, copies):
    return spark.createDataFrame(list(copies.items()), "doc_id long, text string")


def test_stage_keeps_what_brute_force_keeps(spark, copies, linked):
    found = corpus_pipeline.deduplicate(spark, _frame(spark, copies), SMALL)
    assert sorted(r["doc_id"] for r in found.collect()) == _kept(copies, linked)


def test_lists_in_blocks(spark, copies, linked):
    found = near_copies.keep_one(_frame(spark, copies), block=40)
    assert sorted(r["doc_id"] for r in found.collect()) == _kept(copies, linked)


def test_recall_of_pairs(copies, linked):
    keys = {i: near_copies.sketch(near_copies.shingles(t.encode())) for i, t in copies.items()}
    n = near_copies.BANDS
    near = [
        (keys[a][:n] == keys[b][:n]).any() and near_copies.np.bitwise_count(keys[a][n:] ^ keys[b][n:]).sum() <= near_copies.FAR
        for a, b in linked
    ]
    assert len(near) > 1000 and sum(near) >= 0.999 * len(near)


def test_rows_and_columns_stay(spark):
    rows = [(None, "a b c d e f", 1), (7, "a b c d e f", 2), (7, "a b c d e f", 2), (8, None, 3), (9, "", 4), (None, "x y", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int").withColumn("node", F.lit("clash"))
    found = near_copies.keep_one(docs)
    assert found.columns == docs.columns
    assert sorted((r["root"] for r in found.collect())) == [2, 3, 5]
    assert near_copies.keep_one(docs.limit(0)).collect() == []


def test_noisy_lists_longer_than_a_block(spark):
    """300 copies around the limit of similarity, in blocks of 64: every link that all pairs give is kept."""
    rng = random.Random(11)
    words = [f"word{rng.randrange(5000)}" for _ in range(200)]
    texts = dict(enumerate(_changed(words, 0.021, rng) for _ in range(300)))
    sets = {i: _shingles(t) for i, t in texts.items()}
    near = {(a, b) for a, b in combinations(texts, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    expected = _kept(texts, near)
    assert 1 < len(expected) < 290
    found = near_copies.keep_one(_frame(spark, texts), block=64)
    assert sorted(r["doc_id"] for r in found.collect()) == expected
