"""Documents drawn so that every source comes near its target share of words, by pivotal rounding.

Each document of a source is due the same fractional number of copies.  Its whole part is certain; the
fractions are rounded in pairs: words move at random from one document to the other, keeping their sum and
the expectation of each, until one of the two has a whole number of copies.  Pairs are folded within
blocks of some ``FAN`` documents; what a block leaves over (one document) goes on to a block of the next
level, until a source has one block.  So a source misses its target by less than one document.  All
random choices are hashes, so a rerun gives the same mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, salted_join, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
FAN = 64
_STEP = 100_000


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chance(*parts: Column | str) -> Column:
    """A number from 0 up to 1 that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``key, source, source_size`` (a row per source) with each source's target.

    Sources by code point, null last, have the weights in turn.  Together they get ``share`` of all sizes;
    none gets more than ``most`` times its own, and the rest goes to the others by weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    # in the order in which sources reach their caps, the level of the water once all before are at theirs
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    due = F.sum("source_size").over(total) * float(share)
    rows = rows.withColumn("level", (due - before) / rest).withColumn("level", F.max("level").over(total))
    return rows.select("key", "source", "source_size", "items", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _pair(state: Column, x: Column, seed: int) -> Column:
    """Fold one more document into a block: state.open is the one with a fraction, state.done those without."""

    def moved(c: Column) -> Column:
        to_c, to_x = F.least((1 - c.p) * c.size, x.p * x.size), F.least(c.p * c.size, (1 - x.p) * x.size)
        up = _chance(c.doc_id, c.size, x.doc_id, x.size, F.lit(seed)) * (to_c + to_x) < to_x
        c_full, c_empty = (1 - c.p) * c.size <= x.p * x.size, c.p * c.size <= (1 - x.p) * x.size
        new_c = F.when(up & c_full, 1.0).when(up, c.p + x.p * x.size / c.size).when(c_empty, 0.0)
        new_c = new_c.otherwise(c.p - (1 - x.p) * x.size / c.size)
        new_x = F.when(up & c_full, x.p - (1 - c.p) * c.size / x.size).when(up, 0.0)
        new_x = new_x.when(c_empty, x.p + c.p * c.size / x.size).otherwise(1.0)
        settled = F.when(up, c_full).otherwise(c_empty)
        return F.struct(_with(c, new_c).alias("c"), _with(x, new_x).alias("x"), settled.alias("settled"))

    return F.when(state.open.isNull(), F.struct(x.alias("open"), state.done.alias("done"))).otherwise(
        _let(
            moved(state.open),
            lambda m: F.struct(
                F.when(m.settled, m.x).otherwise(m.c).alias("open"),
                F.concat(state.done, F.array(F.when(m.settled, m.c).otherwise(m.x))).alias("done"),
            ),
        )
    )


def _with(item: Column, p: Column) -> Column:
    return F.struct(item.size.alias("size"), item.doc_id.alias("doc_id"), p.alias("p"), item.u.alias("u"))


_ITEM = "struct<size:bigint,doc_id:bigint,p:double,u:double>"


def _round(items: DataFrame, most_items: int, seed: int, fan: int) -> DataFrame:
    """``key, n, doc_id, size, p`` with fractions to key, doc_id, size, up (0 or 1)."""
    open_ = items.withColumn("u", _chance("doc_id", "size", F.lit(seed))).select(
        "key", "n", F.struct("size", "doc_id", "p", "u").alias("item")
    )
    decided, width = [], 1
    while True:
        width *= fan
        block = F.floor(F.col("item.u") * F.ceil(F.col("n") / width))
        start = F.struct(F.lit(None).cast(_ITEM).alias("open"), F.array().cast(f"array<{_ITEM}>").alias("done"))
        # the largest first, so that a small one is left over
        folded = F.aggregate(F.reverse(F.array_sort("items")), start, lambda s, x: _pair(s, x, seed))
        blocks = open_.groupBy("key", "n", block.alias("block")).agg(F.collect_list("item").alias("items"))
        level = stage(blocks.select("key", "n", folded.alias("s")), "rounds")
        decided.append(level.select("key", F.explode("s.done").alias("item")))
        open_ = level.select("key", "n", F.col("s.open").alias("item"))
        if width >= most_items:
            break
    last = open_.select("key", _with(F.col("item"), F.col("item.p") + 0.0).alias("item"))
    chance = _chance("item.doc_id", "item.size", F.lit(seed), F.lit("last"))
    found = [d.select("key", "item.doc_id", "item.size", F.round("item.p").cast("long").alias("up")) for d in decided]
    found.append(last.select("key", "item.doc_id", "item.size", (chance < F.col("item.p")).cast("long").alias("up")))
    whole = found[0]
    for other in found[1:]:
        whole = whole.unionByName(other)
    return whole


def _sized(docs: DataFrame) -> dict[str, Column]:
    return {
        "__key": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
        "__size": F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long"),
    }


def copies(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, seed: int = 7, fan: int = FAN) -> DataFrame:
    """Rows alike in source, doc_id and size as one: key, doc_id, size, n (rows), copies (of all n together),
    source, source_size, target."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", *[c.alias(n[2:]) for n, c in _sized(docs).items()])
    alike = sized.groupBy("key", "doc_id", "size").agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("n"))
    alike = stage(alike, "sizes")
    by_source = alike.groupBy("key").agg(
        F.first("source").alias("source"),
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.count(F.lit(1)).alias("items"),
    )
    sources = stage(source_targets(by_source, weights, share, most), "targets")
    most_items = sources.agg(F.max("items")).first()[0] or 0
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * F.col("n")
    items = salted_join(alike.drop("source"), sources, ["key"], F.xxhash64("doc_id"), "inner").withColumn("due", due)
    items = items.withColumn("sure", F.floor("due")).withColumn("p", F.col("due") - F.col("sure"))
    parted = items.filter("size > 0 and p > 0").select("key", F.col("items").alias("n"), "doc_id", "size", "p")
    rounded = _round(parted, most_items, seed, fan)
    keys = ["key", "doc_id", "size"]
    same = [items.key == rounded.key, items.doc_id.eqNullSafe(rounded.doc_id), items["size"] == rounded["size"]]
    joined = items.join(rounded, same[0] & same[1] & same[2], "left")
    return joined.select(
        *[items[c] for c in keys],
        "n",
        (F.col("sure") + F.coalesce("up", F.lit(0))).alias("copies"),
        "source",
        "source_size",
        "target",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """For every row: doc_id, size (words), source_size, target (of its source), taken (words), source, copies.

    A null text has size 0; a null source is a source of its own.  Repeated rows share their copies, so
    that two rows alike differ by one copy at most.  Sources without words have target 0.  Other columns are
    not looked at; an empty table gives no rows.
    """
    found = copies(docs, **options)
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _STEP)))
    rows = found.withColumn("part", part).withColumn(
        "j",
        F.explode(F.sequence(F.col("part") * _STEP, F.least(F.col("n") - 1, F.col("part") * _STEP + _STEP - 1))),
    )
    own = F.floor(F.col("copies") / F.col("n")) + (F.col("j") < F.col("copies") % F.col("n")).cast("long")
    return rows.withColumn("own", own).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("own")).alias("taken"), "source", F.col("own").alias("copies")
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, all columns, and ``copy`` (from 1)."""
    marked = docs.withColumns(_sized(docs) | {"__id": F.col("doc_id").cast("long")})
    same = Window.partitionBy("__key", "__id", "__size").orderBy(F.xxhash64("text"))
    marked = marked.withColumn("__j", F.row_number().over(same) - 1)
    found = copies(docs, **options).select(*[F.col(c).alias(f"__found_{c}") for c in ("key", "doc_id", "size", "n", "copies")])
    joined = marked.join(
        found,
        (F.col("__key") == F.col("__found_key"))
        & F.col("__id").eqNullSafe(F.col("__found_doc_id"))
        & (F.col("__size") == F.col("__found_size")),
    )
    own = F.floor(F.col("__found_copies") / F.col("__found_n")) + (
        F.col("__j") < F.col("__found_copies") % F.col("__found_n")
    ).cast("long")
    taken = joined.withColumn("__own", own).filter("__own > 0")
    name = "copy" if "copy" not in docs.columns else "mixture_copy"
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__own").cast("int"))).alias(name))
