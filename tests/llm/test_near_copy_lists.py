"""Long lists of near copies are compared within a task: links leave it, pairs do not; and texts move in small batches."""

import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
from tests.llm.test_near_copies import _changed, _kept

from eventmart.llm import common, near_copies


def _sets(n, share):
    rng = random.Random(11)
    words = [f"word{rng.randrange(5000)}" for _ in range(200)]
    return [near_copies.shingles(_changed(words, share, rng).encode()) for _ in range(n)]


def _cell(sets, roots):
    bits = np.stack([near_copies.simhash(x) for x in sets])[:, : near_copies._WORDS].view(np.int64)
    columns = {"node": np.arange(len(sets)), "root": np.array(roots)}
    columns |= {c: np.ascontiguousarray(bits[:, i]) for i, c in enumerate(near_copies._BITS)}
    return pa.table(columns | {"shingles": pa.array([x.tobytes() for x in sets], pa.binary())}), bits.view(np.uint64)


def _reachable(sets, bits):
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)]
    near = [p for p in pairs if np.bitwise_count(bits[p[0]] ^ bits[p[1]]).sum() <= near_copies.FAR]
    return [(a, b) for a, b in near if near_copies.similar(sets[a], sets[b])], near


def test_cell_connects_what_all_its_pairs_connect():
    sets = [*_sets(150, 0.021), *[near_copies.shingles(b"")] * 2]
    cell, bits = _cell(sets, range(len(sets)))
    links, near = _reachable(sets, bits)
    found = near_copies._cell_links(cell).to_pylist()
    found = [(r["a"], r["b"]) for r in found]
    assert 1 < len(_kept(range(len(sets)), links)) < 140 and len(near) > 10 * len(sets)
    assert set(found) <= set(links) | {(b, a) for a, b in links}
    assert len(found) < len(sets)
    assert _kept(range(len(sets)), found) == _kept(range(len(sets)), links)


def test_groups_known_before_are_not_linked_again():
    sets = _sets(60, 0.004)
    cell, _ = _cell(sets, [0] * 30 + [30] * 30)
    assert near_copies._cell_links(cell).num_rows == 1
    assert near_copies._cell_links(_cell(sets, [0] * 60)[0]).num_rows == 0


def test_rows_of_a_list_grow_with_its_texts():
    """Twice the texts of a list just under the limit: about twice the rows that leave the scan, none of them a pair later on."""
    rows = []
    for n in (100, 200):
        _, bits = _cell(_sets(n, 0.04), range(n))
        for band in (0, near_copies.EARLY):
            found = [np.stack(p) for p in near_copies._first_pairs(np.full(n, band), bits)]
            a, b = np.concatenate(found, axis=1)
            assert (a == b).sum() <= n and (a != b).sum() <= (n - 1) * (band < near_copies.EARLY)
            rows.append(len(a))
    assert rows[2] <= 2.5 * rows[0] and rows[3] <= 2.5 * rows[1]


def test_texts_go_to_python_in_small_batches(spark):
    key = common._ARROW_ROWS
    before = spark.conf.get(key)
    docs = spark.range(3000).selectExpr("id as doc_id", "'some words of a text ' || id as text").coalesce(1)

    def sizes(batches):
        yield from (pa.record_batch([pa.array([b.num_rows])], names=["n"]) for b in batches)

    try:
        spark.conf.set(key, "10000")
        corpus_pipeline.deduplicate(spark, docs.limit(3), "")
        assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) <= common.TEXT_ROWS
        wide = common.stage(docs.mapInArrow(sizes, "n long"), "sizes", batch_rows=2000)
        assert max(r["n"] for r in wide.collect()) == 2000
        assert int(spark.conf.get(key)) == common.TEXT_ROWS
    finally:
        spark.conf.set(key, before)
