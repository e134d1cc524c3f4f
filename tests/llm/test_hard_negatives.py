"""BOND scans against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import hard_negatives

_SCHEMA = "vec_id long, embedding array<double>, label int"


def _clamped(x):
    return max(-(1 << 63), min((1 << 63) - 1, x))


def _expected(rows, anchor, positives=5, negatives=5, scale=256):
    whole = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole.append((vec_id, label, [_clamped(int(np.floor(scale * x))) for x in vector]))
    out = []
    for i, (a_id, a_label, a) in enumerate(whole):
        if not anchor(a_id):
            continue
        scored = [(-_clamped(sum(x * y for x, y in zip(a, v, strict=True))), v_id, label) for j, (v_id, label, v) in enumerate(whole) if i != j and len(v) == len(a)]
        for p, p_id, _ in sorted(s for s in scored if s[2] == a_label)[:positives]:
            hard = [s for s in sorted(scored) if s[2] != a_label and -4 * p <= -5 * s[0] and -s[0] <= -p]
            out += [(a_id, p_id, k + 1, n_id, -p, -n) for k, (n, n_id, _) in enumerate(hard[:negatives])]
    return sorted(out)


def _found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize(("n", "dim", "labels", "values"), [(300, 20, 3, "normal"), (200, 3, 2, "few"), (150, 9, 2, "positive"), (40, 1, 2, "few")])
def test_as_brute_force(spark, monkeypatch, n, dim, labels, values):
    monkeypatch.setattr(hard_negatives, "BLOCK_LEAST", 64 * dim)  # several blocks
    rng = np.random.default_rng(n)
    draw = {"normal": lambda: rng.normal(size=dim), "few": lambda: rng.integers(-1, 2, dim) / 16.0, "positive": lambda: rng.random(dim)}[values]
    rows = [(i, [float(x) for x in draw()], int(rng.integers(labels))) for i in range(n)]
    found = hard_negatives.mine(spark.createDataFrame(rows, _SCHEMA), F.col("vec_id") % 7 == 0)
    expected = _expected(rows, lambda i: i % 7 == 0)
    assert _found(found) == expected and (len(expected) > 50 or dim == 1)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, [1.0, 1.0], 1),
        (10, [1.0, 2.0], 1),
        (10, [1.0, 2.0], 1),  # a repeated row stands for itself
        (10, [2.0, 1.0], 2),  # and so does a repeated id
        (20, [1.0, 2.0], 1),
        (21, [1.0, 1.9], 2),
        (22, [1.0, 1.9], 2),
        (23, None, 2),
        (24, [1.0, nan], 2),
        (25, [inf, 1.0], 2),
        (26, [1.0, None], 2),
        (27, [1.0, 1.0], None),
        (28, [1.0], 2),
        (29, [1.0, 2.0, 3.0], 1),
        (30, [], 1),
        (31, [], 1),
        (32, [], 2),
        (40, [1e12, 1e12], 1),  # scores beyond a long
        (41, [1e12, 1.5e12], 1),
        (42, [9e11, 1.2e12], 2),
        (43, [-1e300, 0.0], 2),
    ]
    frame = spark.createDataFrame(rows, _SCHEMA).withColumns({"row": F.lit("clash"), "dim": F.lit(7), "block": F.lit(None)})
    found = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0)
    expected = _expected(rows, lambda i: i is not None and i % 10 == 0)
    assert _found(found) == expected and any(r[4] == (1 << 63) - 1 for r in expected)
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives.mine(frame, F.lit(False)).collect() == []


def test_scan_clears_candidates():
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(500, 64)) * 256).astype(np.int64)
    ids = rng.permutation(500)
    block = hard_negatives.Block(np.arange(500), ids, np.zeros(500, np.int64), vectors)
    anchor = vectors[3]
    scores = vectors @ anchor
    for window in ((None, None), (0, 4000), (-10**6, 10**6), (5, 4)):
        low, high = (-np.inf if window[0] is None else window[0]), (np.inf if window[1] is None else window[1])
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if low <= s <= high)[:5]
        [(places, found)] = block.scan(anchor, np.ones(500, bool), [window], 5)
        assert [(-s, int(block.ids[p])) for p, s in zip(places, found, strict=True)] == best
