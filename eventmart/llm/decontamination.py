"""Benchmark passages in documents, found with a generalised suffix automaton of the benchmark's items.

A window is ``window`` consecutive words of an item; a shorter item is one window.  Items are dealt into shards of
some ``SHARD_WORDS`` words, whose automata are built in tasks and written to the shared folder; long items are dealt
in pieces that overlap by a window less one word, so that a piece holds each window.  Documents are streamed through
the automata of ``PASS_SHARDS`` shards at a time, which is what the driver and a task hold of the benchmark: at every
word the length of the longest suffix that occurs in some item tells which windows end there.  Marks of several
passes are combined per document.  Before the automaton, words are looked up in the items' vocabulary and word
pairs in a table of theirs; the automaton only sees runs in which every pair occurs in an item, which
changes nothing since any other pair resets the matching length below a window.
"""

from __future__ import annotations

import pickle
import re
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from .automaton import SuffixAutomaton
from .common import as_bytes, share, stage

WINDOW = 10
#: Words of items in one automaton, about; more items make more automata.
SHARD_WORDS = 200_000
#: Windows in one piece of an item.
PIECE_WORDS = 10_000
#: Automata that are broadcast for one pass over the documents.
PASS_SHARDS = 2
_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Lower-cases A-Z; other ASCII characters that are no part of words become spaces.
_FOLD = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256)).lower()
_PAIRS = 1 << 22


def words_of(text: bytes) -> list[bytes]:
    """Words of digits, letters and anything beyond ASCII; A-Z in lower case."""
    return text.translate(_FOLD).split()


def _slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * 2654435761 + b * 40503) & (_PAIRS - 1)


class Items:
    """Automaton of one shard of items and the windows that end in each of its states."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        ids = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        self.automaton = sam = SuffixAutomaton()
        self.pairs = np.zeros(_PAIRS, bool)
        for tokens in ids:
            sam.add(tokens)
            self.pairs[_slots(np.array(tokens[:-1], np.int64), np.array(tokens[1:], np.int64))] = True
        self.shortest = min([window, *map(len, ids)])
        own: dict[int, dict[int, set[int]]] = {}
        for (name, _), tokens in zip(items, ids, strict=True):
            size, state, matched = min(window, len(tokens)), 0, 0
            for token in tokens:
                state, matched = sam.step(state, matched, token)
                if matched >= size:
                    own.setdefault(sam.ancestor(state, size), {}).setdefault(size, set()).add(name)
        #: By state: windows that end in it, as (length, items); longer ones come last.
        self.windows: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(sam.link)
        for state in sorted(range(1, len(sam.link)), key=sam.length.__getitem__):
            mine = tuple((n, frozenset(names)) for n, names in sorted(own.get(state, {}).items()))
            self.windows[state] = self.windows[sam.link[state]] + mine

    def dump(self) -> bytes:
        """The shard as bytes of plain values, for ``load`` in any process."""
        return pickle.dumps((self.vocabulary, vars(self.automaton), self.pairs, self.shortest, self.windows))

    @classmethod
    def load(cls, data: bytes) -> Items:
        items = cls.__new__(cls)
        items.vocabulary, automaton, items.pairs, items.shortest, items.windows = pickle.loads(data)
        items.automaton = SuffixAutomaton()
        vars(items.automaton).update(automaton)
        return items

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words are inside an occurrence of a window, and the items those windows are of."""
        n, names = len(words), set()
        marks = np.zeros(n + 1, np.int64)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, n)
        known = ids >= 0
        if not known.any():
            return np.zeros(n, bool), names
        joined = known[1:] & known[:-1] & self.pairs[_slots(ids[:-1], ids[1:])]
        starts = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        ends = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        long = ends - starts >= self.shortest
        step, windows = self.automaton.step, self.windows
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            state = matched = 0
            for at, token in enumerate(ids[start:end].tolist(), start):
                state, matched = step(state, matched, token)
                longest = 0
                for size, items in windows[state]:
                    if size <= matched:
                        longest = size
                        names |= items
                if longest:
                    marks[at + 1 - longest] += 1
                    marks[at + 1] -= 1
        return np.cumsum(marks[:n]) > 0, names


def _pieces_udf(window: int, piece_words: int):
    """Column function: text to its pieces, words joined by spaces; none without words."""

    @F.arrow_udf("array<string>")
    def of(texts: pa.Array) -> pa.Array:
        found = []
        for text in as_bytes(texts):
            words = words_of(text or b"")
            starts = range(0, max(1, len(words) - window + 1), max(1, piece_words)) if words else ()
            found.append([b" ".join(words[i : i + piece_words + window - 1]).decode("utf-8") for i in starts])
        return pa.array(found, pa.list_(pa.string()))

    return of


def build_shards(
    benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, piece_words: int = PIECE_WORDS
) -> DataFrame:
    """``shard, automaton``: the benchmark's items as pickled automata, one per task, numbered from 0.

    Items without id, text or words are left out.  The driver learns the number of words only.
    """
    rows = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    pieces = rows.select("item_id", F.explode(_pieces_udf(window, piece_words)("text")).alias("piece")).distinct()
    pieces = stage(pieces, "pieces")
    n_words = pieces.agg(F.sum(F.size(F.split("piece", " ")))).first()[0] or 0
    shard = F.pmod(F.xxhash64("item_id", "piece"), F.lit(max(1, -(-n_words // shard_words)))).cast("int")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        items = Items([(i, p.encode("utf-8").split(b" ")) for i, p in zip(group["item_id"], group["piece"], strict=True)], window)
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "automaton": [items.dump()]})

    built = pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(build, "shard int, automaton binary")
    return stage(built, "automata")


def load_shards(automata: DataFrame, first: int, count: int) -> list[Items]:
    """The automata of some shards."""
    chosen = automata.filter(F.col("shard").between(first, first + count - 1)).orderBy("shard")
    return [Items.load(r["automaton"]) for r in chosen.collect()]


def _scan(all_items: list[Items], words: list[bytes]) -> tuple[np.ndarray, set[int]]:
    mask, names = np.zeros(len(words), bool), set()
    for items in all_items:
        found, more = items.hits(words)
        mask |= found
        names |= more
    return mask, names


_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def report_udf(spark: SparkSession, shards: list[Items], item_type: pa.DataType):
    """Column function: text to ``struct<n_words, spans, items>``; spans are runs of hit words, ends exclusive."""
    shared = share(spark, shards)
    of_items = from_arrow_type(item_type).simpleString()

    @F.arrow_udf(f"n_words long, spans array<struct<a: long, b: long>>, items array<{of_items}>")
    def report(texts: pa.Array) -> pa.Array:
        shards, n_words, spans, items = shared(), [], [], []
        for text in as_bytes(texts):
            words = words_of(text or b"")
            mask, names = _scan(shards, words)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))).reshape(-1, 2).tolist()
            n_words.append(len(words))
            spans.append([{"a": a, "b": b} for a, b in edges])
            items.append(list(names))
        columns = [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(item_type))]
        return pa.StructArray.from_arrays(columns, names=["n_words", "spans", "items"])

    return report


def marked(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    pass_shards: int = PASS_SHARDS,
) -> DataFrame:
    """``docs`` with ``__found``: number of words, runs of hit words (runs of several passes may overlap) and items."""
    spark = docs.sparkSession
    automata = build_shards(benchmark, window, shard_words)
    last = automata.agg(F.max("shard")).first()[0]
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    starts = range(0, 0 if last is None else last + 1, pass_shards)
    if len(starts) <= 1:
        return docs.withColumn("__found", report_udf(spark, load_shards(automata, 0, pass_shards), item_type)("text"))
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    passes = []
    for first in starts:
        report = report_udf(spark, load_shards(automata, first, pass_shards), item_type)
        passes.append(stage(rows.select("__row", report("text").alias("f")).select("__row", "f.*"), "marks"))
    found = reduce(DataFrame.unionByName, passes).groupBy("__row").agg(
        F.struct(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        ).alias("__found")
    )
    return rows.join(found, "__row").drop("__row")


def _covered(spans: Column) -> Column:
    """Number of words inside spans that may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(done: Column, span: Column) -> Column:
        new = F.greatest(span["b"] - F.greatest(done["end"], span["a"]), F.lit(0))
        return F.struct(F.greatest(done["end"], span["b"]).alias("end"), (done["total"] + new).alias("total"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda done: done["total"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    pass_shards: int = PASS_SHARDS,
) -> DataFrame:
    """For every row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words.  Repeated rows stay, repeated items count once, other columns are not looked
    at; without documents there are no rows, without items nothing is hit.  Texts are used whole.
    """
    found = marked(docs.select("doc_id", "text"), benchmark, window, shard_words, pass_shards)
    names: Column = F.array_sort(F.transform("__found.items", lambda x: x.cast("string")))
    counted = found.select("doc_id", F.col("__found.n_words").alias("n_words"), _covered(F.col("__found.spans")).alias("n_hit"), names.alias("names"))
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("names").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "names"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def cut_udf(span_words: int, coverage: float):
    """Column function: text and its spans to what is left of it, null if more than ``coverage`` of its words are hit."""

    def cut(text: bytes, spans: list[dict]) -> bytes | None:
        places = [m.span() for m in _TOKEN.finditer(text)]
        mask = np.zeros(len(places), bool)
        for span in spans:
            mask[span["a"] : span["b"]] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
        runs = [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= span_words]
        if not runs:
            return text
        if mask.mean() > coverage:
            return None
        kept, at = [], 0
        for a, b in runs:
            kept.append(text[at : places[a][0]])
            at = places[b - 1][1]
        return b"".join([*kept, text[at:]])

    @F.arrow_udf("string")
    def cut_texts(texts: pa.Array, spans: pa.Array) -> pa.Array:
        pairs = zip(as_bytes(texts), spans.to_pylist(), strict=True)
        return pa.array([cut(t, s) if s and t is not None else t for t, s in pairs], pa.binary()).cast(pa.string())

    return cut_texts


def remove_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    span_words: int = 1,
    coverage: float = 0.5,
    shard_words: int = SHARD_WORDS,
    pass_shards: int = PASS_SHARDS,
) -> DataFrame:
    """Documents without the benchmark's passages; all columns, n_chars (if there) as of the new text.

    Runs of at least ``span_words`` hit words are cut out with the characters between them; a document
    that has one and of whose words more than the share ``coverage`` are hit is dropped.  Other documents stay as they
    are, null texts included.
    """
    cut = cut_udf(span_words, coverage)
    found = marked(docs, benchmark, window, shard_words, pass_shards)
    # not deterministic to the optimizer, so that it runs once per row
    found = found.withColumn("__left", cut.asNondeterministic()("text", "__found.spans"))
    found = found.filter("text is null or __left is not null")
    changed = {"text": F.col("__left")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("__left") == F.col("text"), F.col("n_chars")).otherwise(F.length("__left"))
        changed["n_chars"] = changed["n_chars"].cast(docs.schema["n_chars"].dataType)
    return found.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
