"""The prefix trie against a plain one, and centroid decomposition against plain subtree sums."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from eventmart.llm import prefix_trie

_SCHEMA = "conv_id long, turn int, role string, text string"


def _expected(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in turns.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = own.get(base, [])[:h] + ts[h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [totals[c] for c in children.get(node, [])]
        totals[node] = (sum(b[0] for b in below) or 1, (len(members[node]) - 1) * words + sum(b[1] for b in below))
    out = []
    for node, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, ended in own_members if ended))
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(c for c, _ in own_members), len(node), parent, len(own_members), len(children.get(node, [])), *totals[node], sha))
    return sorted(out, key=str)


def _found(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def _random_rows(seed, convs, turns, words):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", None, ""]), rng.choice(["a b", "c", "", None, "d e f"][:words])) for c in range(convs) for t in range(rng.randint(1, turns))]


@pytest.mark.parametrize("most", [1, 4, 10**6])
def test_as_plain(spark, most):
    rows = _random_rows(2, 70, 9, 3)
    frame = spark.createDataFrame(rows, _SCHEMA).repartition(5)
    assert _found(prefix_trie.prefix_trie(frame, component_most=most)) == _expected(rows)


def test_long_path_over_several_tasks(spark):
    rng = random.Random(8)
    rows = [(20, t, "user", f"t{t}") for t in range(150)] + [(21, t, "user", f"t{t}") for t in range(90)] + [(22, t, "user", rng.choice("xy")) for t in range(30)]
    frame = spark.createDataFrame(rows, _SCHEMA).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _found(prefix_trie.prefix_trie(frame, component_most=12)) == _expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hard_rows(spark):
    rows = [
        (None, 0, "user", "of no conversation"),
        (40, None, "user", "before the first"),
        (40, 0, None, None),
        (40, 0, None, None),  # a repeated row
        (40, 0, "b", "tie"),
        (41, 0, "user", "x"),
        (47, 5, "", "word " * 20_000),
        (-7, 1, "user", "below zero"),
        (-20, 1, "user", "its base"),
        (63, 0, "user", "without a base"),
    ]
    frame = spark.createDataFrame(rows, _SCHEMA).withColumns({"key": F.lit("clash"), "depth": F.lit(3), "n": F.lit(None), "pos": F.lit(1)})
    assert _found(prefix_trie.prefix_trie(frame)) == _expected(rows)
    none = prefix_trie.prefix_trie(frame.limit(0))
    assert none.collect() == [] and none.columns == prefix_trie.prefix_trie(frame).columns


def test_conversations_without_turns(spark):
    convs = [c for c in range(1, 200) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:9]
    rows = [(c, 0, "user", "only turn") for c in convs]
    assert _found(prefix_trie.prefix_trie(spark.createDataFrame(rows, _SCHEMA))) == _expected(rows)


def test_ids_of_a_hot_node_in_pieces(spark, monkeypatch):
    ends = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit(b"a")).otherwise(F.lit(b"b")).alias("key"), F.col("id").alias("conv_id"))
    monkeypatch.setattr(prefix_trie, "CHUNK", 64)
    found = {bytes(r[0]): r[1] for r in prefix_trie.ends_hashes(ends.repartition(7)).collect()}
    sha = lambda a, b: hashlib.sha256(",".join(map(str, range(a, b))).encode()).hexdigest()
    assert found == {b"a": sha(0, 4000), b"b": sha(4000, 5000)}


def test_decomposition_sums_subtrees():
    rng = random.Random(1)
    for kind in ("any", "path", "star", "two"):
        for n in (0, 1, 2, 3, 50, 400):
            choose = {"any": lambda i: rng.randrange(i), "path": lambda i: i - 1, "star": lambda i: 0, "two": lambda i: max(0, i - 2)}[kind]
            parents = [-1, *[choose(i) for i in range(1, n)]][:n]
            values = [[rng.randrange(10) for _ in range(n)] for _ in range(2)]
            expected = [list(v) for v in values]
            for i in range(n - 1, 0, -1):
                for e in expected:
                    e[parents[i]] += e[i]
            assert prefix_trie.decompose(parents, values) == expected
