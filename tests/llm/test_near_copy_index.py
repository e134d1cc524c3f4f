"""The inverted index of SimHash bytes that finds near copies, and the memory that its pairs take."""

from functools import partial

import numpy as np
import pyarrow as pa

from eventmart.llm import near_copies


def _plain(own):
    """SimHash bit by bit, from the same hashes of a shingle."""
    counts = [0] * (64 * near_copies.WORDS)
    for one in own:
        bits = np.unpackbits(near_copies.simhash(np.array([one], np.uint64)).view(np.uint8))
        counts = [n + int(b) for n, b in zip(counts, bits, strict=True)]
    return [2 * n > len(own) for n in counts]


def test_lists_are_pairs_of_simhash_bytes():
    own = np.random.default_rng(3).integers(0, 1 << 63, 600, np.uint64)
    words = near_copies.simhash(own)
    assert np.unpackbits(words.view(np.uint8)).tolist() == _plain(own)
    data, keys = words.tobytes(), near_copies.sketch(own)[: near_copies.BANDS]
    used = [0] * len(data)
    for i, key in enumerate(keys.tolist()):
        x, y = near_copies._PLACES[i].tolist()
        used[x], used[y] = used[x] + 1, used[y] + 1
        assert key == i << 16 | data[x] << 8 | data[y]
    assert set(used) == {2}


def test_least_similar_pairs_share_a_list():
    """2,000 pairs of sets at 0.8: a share of 0.998 meets in a list within the distance."""
    rng, found = np.random.default_rng(4), 0
    for _ in range(2000):
        hashes = rng.integers(0, 1 << 63, 200, np.uint64)
        a, b = (near_copies.sketch(np.unique(x)) for x in (hashes[:180], hashes[20:]))
        n = near_copies.BANDS
        found += (a[:n] == b[:n]).any() and np.bitwise_count(a[n:] ^ b[n:]).sum() <= near_copies.FAR
    assert found >= 0.998 * 2000


def test_pairs_leave_a_task_in_bounded_batches():
    """A list of 1,200 texts alike in all bits, each alone in its group: over 700,000 pairs, never all at once."""
    n = 1200
    columns = [np.zeros(n, np.int64)] * 3 + [np.arange(n), np.arange(n)] + [np.zeros(n, np.int64)] * len(near_copies._BITS)
    cell = pa.record_batch([pa.array(c) for c in columns], names=[f"c{i}" for i in range(len(columns))])
    sizes = [b.num_rows for b in near_copies._scan(partial(near_copies._more_pairs, 4096), iter([cell]))]
    assert sum(sizes) == (n - 1) * (n - 1)
    assert max(sizes) <= near_copies._PAIRS_OUT + n
