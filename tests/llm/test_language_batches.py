"""Scores and counts do not depend on the other texts of a batch."""

import numpy as np

from eventmart.llm import language_id


def test_score_is_the_same_in_any_batch():
    rng = np.random.default_rng(3)
    weights = rng.normal(-9, 1, (1 << 10, 3)).astype(np.float32)
    model = language_id.Model(["a", "b", "c"], weights, np.zeros(3, np.float32), language_id.ORDERS)
    folded, letters = language_id._folded(), list("abcdefgh ")
    texts = [" ".join("".join(rng.choice(letters, 7)) for _ in range(n)).encode() for n in (1, 1, 3, 40, 3000, 1)]
    texts += [b"a", b"b", b"a"]
    alone = np.concatenate([language_id._scores(model, folded, [t]) for t in texts])
    assert (language_id._scores(model, folded, texts) == alone).all()
    assert (language_id._scores(model, folded, texts[::-1]) == alone[::-1]).all()


def test_counts_are_the_same_in_any_batch():
    folded, orders, buckets = language_id._folded(), language_id.ORDERS, 1 << 10

    def counted(texts):
        batch = language_id.pa.record_batch([["x"] * len(texts), texts], names=["label", "text"])
        out = np.zeros(buckets, np.int64)
        for found in language_id._counter(orders, buckets, lambda: folded)([batch]):
            out[found.column(1).to_numpy()] += found.column(2).to_numpy()
        return out

    texts = ["ab c", "d", "efg"]
    assert (counted(texts) == sum(counted([t]) for t in texts)).all()
