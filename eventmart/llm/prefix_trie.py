"""Conversation prefix trie: sequences of first turns shared by conversations, with totals over every subtree.

1. A turn becomes a 127-bit hash and a word count; texts go no further.  Turns are sorted by range and chained task by
   task into prefix hashes ``sum(turn_i * BASE ** i)``.  Such sums can be shifted and added, so a conversation that is
   cut between tasks, or rebuilt from another one's head and its own rest, needs no second reading.
2. A node is a depth and a prefix hash; its members are counted in an aggregation.
3. Subtree totals come from centroid decomposition of the forest below the root.  A component with more nodes than a
   task should hold is split by a Spark round: its centroid is the deepest node below which at least half of the
   component's weight lies (a node weighs its members, so a subtree's weight is known from the aggregation: what its
   members have from there on).  The total below the centroid is added to all nodes from there to the component's top;
   what hangs below it and what is left above are components of their own.  Rounds go on until none is too large, at
   most the logarithm of the weight.  Smaller components are decomposed in the same way within a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, stage

#: Turns that a conversation takes over at most, and the distance of the conversations they are taken from.
HEAD_MOST, HEAD_EVERY = 3, 20
#: Nodes of a component that one task decomposes, at most.
COMPONENT_MOST = 1 << 18
#: The least such limit.
COMPONENT_LEAST = 1 << 8
#: Conversation ids that are joined into one piece of text before hashing.
CHUNK = 8192
_PRIME = (1 << 127) - 1
_BASE = 0x5851F42D4C957F2D14057B7EF767814F % _PRIME
_INVERSE = pow(_BASE, -1, _PRIME)
_NO_TURNS = bytes(16)


def _packed(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _number(x: bytes | None) -> int:
    return int.from_bytes(x, "big") if x else 0


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


_LONG, _KEY = pa.int64(), pa.binary()
_CHAINED = [("part", _LONG), ("conv_id", _LONG), ("pos", _LONG), ("prefix", _KEY), ("before", _KEY), ("words", _LONG), ("edge", pa.bool_())]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conv_id, turn hash, words to places and prefix hashes as if conversations began in this task.

    The last rows of the first and of the last conversation come twice, the second time as ``edge``.
    """
    part, conv, row, cut = TaskContext.get().partitionId(), None, None, False
    pos, prefix, power = 0, 0, 1
    for batch in batches:
        out = []
        for own, turn, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if own != conv:
                if conv is not None and not cut:
                    out.append((*row[:-1], True))
                    cut = True
                conv, pos, prefix, power = own, 0, 0, 1
            pos, power, before = pos + 1, power * _BASE % _PRIME, prefix
            prefix = (prefix + _number(turn) * power) % _PRIME
            row = (part, conv, pos, _packed(prefix), _packed(before), words, False)
            out.append(row)
        yield _batch(out, _CHAINED)
    if row is not None:
        yield _batch([(*row[:-1], True)], _CHAINED)


def _carried(edges: list) -> list[tuple]:
    """part, conv_id, turns and prefix hash of that conversation in earlier tasks, for tasks that begin within one."""
    out, conv, pos, prefix = [], None, 0, 0
    for part, own, count, total in edges:
        if own != conv:
            conv, pos, prefix = own, 0, 0
        elif pos:
            out.append((part, conv, pos, _packed(prefix)))
        prefix = (prefix + _number(total) * pow(_BASE, pos, _PRIME)) % _PRIME
        pos += count
    return out


_PLACED = [("conv_id", _LONG), ("pos", _LONG), ("prefix", _KEY), ("before", _KEY), ("words", _LONG)]


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, pos, prefix, before, words, turns, carried in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if turns:
                power, start = pow(_BASE, turns, _PRIME), _number(carried)
                prefix, before = (_packed((start + _number(x) * power) % _PRIME) for x in (prefix, before))
                pos += turns
            out.append((conv, pos, prefix, before, words))
        yield _batch(out, _PLACED)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), prefix and before (hash of the turns up to this one, and up to the one before), words.

    Turns go by ``turn``, null first, then by their hash.  Rows without conv_id belong to no conversation.
    """
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("hash"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("nth"),
    )
    order = ["conv_id", "turn", "hash", "nth"]
    dealt = stage(turns, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = "part long, conv_id long, pos long, prefix binary, before binary, words long, edge boolean"
    chained = stage(dealt.select("conv_id", "hash", "words").mapInArrow(_chain, kinds), "chained")
    edges = chained.filter("edge").select("part", "conv_id", "pos", "prefix")  # two rows per task at most
    carried = _carried(sorted({tuple(r) for r in edges.collect()}, key=lambda r: r[:2]))
    carried = spark.createDataFrame(carried, "part long, conv_id long, turns long, carried binary")
    rows = chained.filter("not edge").join(F.broadcast(carried), ["part", "conv_id"], "left")
    rows = rows.select("conv_id", "pos", "prefix", "before", "words", "turns", "carried")
    return stage(rows.mapInArrow(_shift, "conv_id long, pos long, prefix binary, before binary, words long"), "placed", drop=(chained,))


_PREFIXES = [("conv_id", _LONG), ("depth", _LONG), ("key", _KEY), ("parent", _KEY), ("top", _KEY), ("words", _LONG), ("length", _LONG)]


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns after the head, with what precedes them, to prefixes of the rebuilt conversation."""
    for batch in batches:
        out = []
        for conv, pos, prefix, before, words, head, taken, start, skipped, first, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            start, skipped, back = _number(start), _number(skipped), pow(_INVERSE, head - taken, _PRIME)
            whole = [_packed((start + (_number(x) - skipped) * back) % _PRIME) for x in (prefix, before)]
            if not taken:  # the first turn left is the first of the rebuilt one
                first = _packed((_number(first) - skipped) * back % _PRIME)
            out.append((conv, pos - head + taken, *whole, first, words, length))
        yield _batch(out, _PREFIXES)


def rebuilt_prefixes(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefixes of the rebuilt conversations (a row per conversation and depth from 1), and conv_id, length of each.

    Conversation c takes the first h turns of c - c % 20 and goes on with its own after its first h, where h is the
    CRC-32 of its decimal id modulo 4.
    """
    own = F.col("pos")
    heads = [F.max(F.when(own == i, F.struct("prefix", "before", "words"))).alias(f"p{i}") for i in range(1, HEAD_MOST + 2)]
    convs = stage(placed.groupBy("conv_id").agg(F.max(own).alias("turns"), *heads), "conversations")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEAD_MOST + 1)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % HEAD_EVERY
    every = F.array(*[F.col(f"p{i}") for i in range(1, HEAD_MOST + 2)])
    bases = convs.filter(F.col("conv_id") % HEAD_EVERY == 0).select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"), F.slice(every, 1, HEAD_MOST).alias("given"))
    info = convs.select("conv_id", "turns", every.alias("p"), head.alias("head"), base.alias("base")).join(bases, "base", "left")
    taken = F.least("head", F.coalesce("base_turns", F.lit(0))).cast("int")
    none = F.lit(_NO_TURNS)

    def prefix(of: str, n):
        return F.coalesce(F.get(of, n - 1)["prefix"], none)

    info = info.withColumn("taken", taken).select(
        "conv_id",
        "turns",
        "head",
        "taken",
        prefix("given", F.col("taken")).alias("start"),
        prefix("p", F.least(F.col("head"), F.col("turns").cast("int"))).alias("skipped"),
        F.when(F.col("taken") > 0, F.get("given", F.lit(0))["prefix"]).otherwise(F.get("p", F.col("head"))["prefix"]).alias("first"),
        (F.col("taken") + F.greatest(F.col("turns") - F.col("head"), F.lit(0))).alias("length"),
        F.slice(F.coalesce("given", F.array().cast("array<struct<prefix:binary,before:binary,words:bigint>>")), F.lit(1), F.col("taken")).alias("given"),
    )
    info = stage(info, "rebuilt")
    rest = placed.join(info.filter("turns > head").drop("given", "turns"), "conv_id").filter("pos > head")
    rest = rest.select("conv_id", "pos", "prefix", "before", "words", "head", "taken", "start", "skipped", "first", "length")
    kinds = "conv_id long, depth long, key binary, parent binary, top binary, words long, length long"
    given = info.select("conv_id", F.posexplode("given").alias("at", "turn"), "first", "length").select(
        "conv_id",
        (F.col("at") + 1).cast("long").alias("depth"),
        F.col("turn.prefix").alias("key"),
        F.col("turn.before").alias("parent"),
        F.col("first").alias("top"),
        F.col("turn.words").alias("words"),
        F.col("length").cast("long").alias("length"),
    )
    return stage(rest.mapInArrow(_rebuild, kinds).unionByName(given), "prefixes"), info.select("conv_id", "length")


def decompose(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """Totals over the subtrees of a tree, by centroid decomposition.  Parents come before children; the top's is -1.

    ``values`` are lists with one number per node.
    """
    n = len(parents)
    children: list[list[int]] = [[] for _ in range(n)]
    size = [1] * n
    for v in range(n - 1, 0, -1):
        children[parents[v]].append(v)
        size[parents[v]] += size[v]
    totals, gone = [[0] * n for _ in values], [False] * n
    tops = [0] if n else []
    while tops:
        top = at = tops.pop()
        while True:  # to the deepest node that has at least half of the component
            heavy = next((c for c in children[at] if not gone[c] and 2 * size[c] >= size[top]), None)
            if heavy is None:
                break
            at = heavy
        below, sums = [at], [0] * len(values)
        for v in below:
            below.extend(c for c in children[v] if not gone[c])
            for k, own in enumerate(values):
                sums[k] += own[v]
        v, lost = at, size[at]
        while True:  # from the centroid to the top
            for k, x in enumerate(sums):
                totals[k][v] += x
            size[v] -= lost
            if v == top:
                break
            v = parents[v]
        gone[at] = True
        tops.extend(c for c in children[at] if not gone[c])
        if at != top:
            tops.append(top)
    return totals


_ROLLED = [("depth", _LONG), ("key", _KEY), ("n_leaves", _LONG), ("saved_tokens", _LONG)]


def _decompose_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components (comp, depth, key, parent, leaf, saved, and what was added so far), sorted, to totals per node."""

    def finished(rows: list[tuple]) -> list[tuple]:
        at = {(r[1], r[2]): i for i, r in enumerate(rows)}
        parents = [at.get((r[1] - 1, r[3]), -1) for r in rows]
        leaves, saved = decompose(parents, [[r[4] for r in rows], [r[5] for r in rows]])
        return [(r[1], r[2], a + r[6], b + r[7]) for r, a, b in zip(rows, leaves, saved, strict=True)]

    held: list[tuple] = []
    for batch in batches:
        out = []
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[0][0] != row[0]:
                out += finished(held)
                held = []
            held.append(row)
        yield _batch(out, _ROLLED)
    if held:
        yield _batch(finished(held), _ROLLED)


_STATE = ["comp", "conv_id", "depth", "key", "parent", "weight", "leaf", "saved", "more_leaves", "more_saved"]


def _split(state: DataFrame, sizes: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: the components' nodes without their centroids, labelled anew, and the centroids' totals.

    ``sizes`` has the weight of every component, ``paths`` the prefixes of the nodes' conversations.
    """
    weighed = state.join(sizes.select("comp", "total"), "comp")
    best = F.max(F.struct("depth", "key", "conv_id", "weight")).alias("c")
    centroids = weighed.filter(2 * F.col("weight") >= F.col("total")).groupBy("comp").agg(best)
    centroids = centroids.select("comp", *[F.col(f"c.{c}").alias(f"c_{c}") for c in ("depth", "key", "conv_id", "weight")])
    # below the centroid's depth, the node's prefix one below it tells the new component; above, the centroid's prefix at
    # the node's depth tells whether the node is on the way to the top
    deep = F.col("depth") > F.col("c_depth")
    asked = state.join(stage(centroids, "centroids"), "comp").withColumns(
        {
            "at_conv": F.when(deep, F.col("conv_id")).otherwise(F.col("c_conv_id")),
            "at_depth": F.when(deep, F.col("c_depth") + 1).otherwise(F.col("depth")),
        }
    )
    known = paths.select(F.col("conv_id").alias("at_conv"), F.col("depth").alias("at_depth"), F.col("key").alias("at_key"), F.col("parent").alias("at_parent"))
    found = asked.join(known, ["at_conv", "at_depth"])
    below = deep & (F.col("at_parent") == F.col("c_key"))
    on_path = ~deep & (F.col("at_key") == F.col("key"))
    found = found.withColumns({"below": below, "on_path": on_path, "is_c": on_path & (F.col("depth") == F.col("c_depth"))})
    found = stage(found.select(*_STATE, "c_weight", "at_key", "below", "on_path", "is_c"), "split")
    totals = found.filter("below or is_c").groupBy("comp").agg(F.sum("leaf").alias("add_leaves"), F.sum("saved").alias("add_saved"))
    raised = found.filter("on_path").join(stage(totals, "totals"), "comp").withColumns(
        {
            "more_leaves": F.col("more_leaves") + F.col("add_leaves"),
            "more_saved": F.col("more_saved") + F.col("add_saved"),
            "weight": F.col("weight") - F.col("c_weight"),
        }
    )
    done = raised.filter("is_c").select("depth", "key", F.col("more_leaves").alias("n_leaves"), F.col("more_saved").alias("saved_tokens"))
    moved = found.filter("not on_path").withColumn("comp", F.when(F.col("below"), F.col("at_key")).otherwise(F.col("comp")))
    return moved.select(*_STATE).unionByName(raised.filter("not is_c").select(*_STATE)), done


def rollup(nodes: DataFrame, prefixes: DataFrame, component_most: int) -> DataFrame:
    """depth, key, n_leaves, saved_tokens: totals of ``leaf`` and ``saved`` over the subtrees of a staged forest.

    ``nodes``: comp (key of the top of the node's tree), conv_id (a member), depth, key, parent, weight (of the whole
    subtree, a node's own being 1 or more), leaf, saved.  ``prefixes``: conv_id, depth, key, parent of the members.
    """
    zero = F.lit(0).cast("long")
    state = nodes.withColumns({"more_leaves": zero, "more_saved": zero}).select(*_STATE)
    small, done, paths = [], [], None
    while True:
        sizes = state.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total"))
        sizes = stage(sizes.filter(F.col("n") > component_most), "large")
        small.append(state.join(sizes.select("comp"), "comp", "left_anti"))
        if not sizes.head(1):
            break
        state = stage(state.join(sizes.select("comp"), "comp", "left_semi"), "components")
        if paths is None:
            paths = stage(prefixes.join(state.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "depth", "key", "parent"), "paths")
        left, centroids = _split(state, sizes, paths)
        state = stage(left, "components")
        done.append(centroids)
    whole = small[0]
    for other in small[1:]:
        whole = whole.unionByName(other)
    whole = whole.select("comp", "depth", "key", "parent", "leaf", "saved", "more_leaves", "more_saved")
    rolled = whole.repartition("comp").sortWithinPartitions("comp", "depth", "key").mapInArrow(
        _decompose_components, "depth long, key binary, n_leaves long, saved_tokens long"
    )
    for other in done:
        rolled = rolled.unionByName(other)
    return rolled


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted key, conv_id to pieces of text."""
    key, ids = None, []
    piece = lambda: (key, ids[0], ",".join(map(str, ids)))
    fields = [("key", _KEY), ("first", _LONG), ("ids", pa.string())]
    for batch in batches:
        out = []
        for own, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if ids and (own != key or len(ids) >= CHUNK):
                out.append(piece())
                ids = []
            key = own
            ids.append(conv)
        yield _batch(out, fields)
    if ids:
        yield _batch([piece()], fields)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one hash per key; of the text only the piece in hand is held."""
    fields, key, digest = [("key", _KEY), ("ends_sha256", pa.string())], None, None
    for batch in batches:
        out = []
        for own, piece in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if own != key:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield _batch(out, fields)
    if digest is not None:
        yield _batch([(key, digest.hexdigest())], fields)


def ends_hashes(ends: DataFrame) -> DataFrame:
    """``key, conv_id`` to key, ends_sha256 over its ids in order.  A hot key's ids are joined to pieces in many tasks."""
    dealt = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = dealt.mapInArrow(_join_ids, "key binary, first long, ids string")
    gathered = pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
    return gathered.mapInArrow(_hash_pieces, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, component_most: int | None = None) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt (see ``rebuilt_prefixes``) and every distinct sequence of first turns (role and text, null
    as empty) is a node; the root stands for no turns.  conv_id is the least member, n_convs the number of members,
    n_children and n_leaves count nodes below, saved_tokens sums (members - 1) times the words of the last text over
    the subtree, ends_sha256 is over the ids of the members that end there.  Turns go by ``turn``, null first, those of
    one number by their hash; a repeated row is a turn of its own.  Rows without conv_id are left out, other columns
    not looked at.  Without conversations there is no node.

    ``component_most``: nodes that a task decomposes; by default what a shuffle partition holds on average, within
    COMPONENT_LEAST and COMPONENT_MOST.
    """
    spark = conversations.sparkSession
    prefixes, lengths = rebuilt_prefixes(placed_turns(conversations))
    members = prefixes.groupBy("depth", "key").agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("parent").alias("parent"),
        F.min("top").alias("comp"),
        F.min("words").alias("words"),
        F.sum("length").alias("lengths"),
    )
    members = stage(members, "members")
    children = members.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = members.join(children, ["depth", "key"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns(
        {
            "weight": F.col("lengths") - F.col("n_convs") * (F.col("depth") - 1),
            "leaf": (F.col("n_children") == 0).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    nodes = stage(nodes.drop("lengths", "words"), "nodes", drop=(members,))
    if component_most is None:
        share = nodes.count() // int(spark.conf.get("spark.sql.shuffle.partitions"))
        component_most = min(COMPONENT_MOST, max(COMPONENT_LEAST, share))
    rolled = stage(rollup(nodes.drop("n_convs", "n_children"), prefixes, component_most), "rolled")
    ends = prefixes.filter("depth = length").select("key", "conv_id")
    ends = ends.unionByName(lengths.filter("length = 0").select(F.lit(_NO_TURNS).alias("key"), "conv_id"))
    hashes = stage(ends_hashes(ends), "ends")
    whole = nodes.join(rolled, ["depth", "key"])
    named = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "key"]
    members = lengths.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    below = whole.filter("depth = 1").agg(F.count(F.lit(1)).alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
    root = [(members["least"], 0, None, members["n"], below["n"], below["leaves"] or 1, below["saved"] or 0, bytearray(_NO_TURNS))]
    kinds = ", ".join(f"{c} {'binary' if c == 'key' else 'long'}" for c in columns)
    root = spark.createDataFrame(root if members["n"] else [], kinds)
    tops = whole.filter("depth = 1").withColumn("parent_conv_id", F.lit(members["least"]).cast("long"))
    others = whole.filter("depth > 1").join(named, ["depth", "parent"])
    found = root.unionByName(tops.select(*columns)).unionByName(others.select(*columns))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return found.join(hashes, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty)).drop("key")
