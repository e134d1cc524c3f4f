"""Token counts of a unigram tokenizer without building its tokens.

An Aho-Corasick automaton finds every vocabulary match in a chunk of text; one pass over the matches
carries, for each position, the best score and the number of pieces of the best segmentation.  Ties go to
the match that starts first, which is what a forward Viterbi with a strict comparison keeps.  Characters
that no piece covers alone cost ten less than the least score and count as their UTF-8 bytes (byte
fallback) or, a run of them together, as one unknown piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import inf

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import share

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words and parts of words whose counts a task remembers.
REMEMBERED = 600_000


@dataclass
class Vocabulary:
    """Pieces with their scores; ``bytes_known``: unknown characters become one token per byte."""

    pieces: dict[str, float]
    bytes_known: bool = True
    prefix_space: bool = True
    joined: bool = field(init=False)

    def __post_init__(self):
        #: True if some piece crosses the start of a word; then a text can't be cut there.
        self.joined = any(SPACE in p.lstrip(SPACE) for p in self.pieces)


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces and scores of a sentencepiece model file, read on the driver as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return Vocabulary({model.id_to_piece(i): float(model.get_score(i)) for i in plain}, any(map(model.is_byte, ids)))


class Counter:
    """Counts tokens with a vocabulary; built once per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, int] = {}  # tokens of words, and of parts of words
        self.inner: dict[str, int] = {}
        self.together = {piece[i : i + 2] for piece in vocabulary.pieces for i in range(len(piece) - 1)}
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        self.unknown = min(vocabulary.pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        self._drop_beaten()

    def _drop_beaten(self) -> None:
        """Leave out pieces that shorter pieces make up with a better score: no best segmentation has them.

        The margin keeps pieces whose order could depend on how sums are rounded.
        """
        beaten = [
            piece
            for piece, score in self.vocabulary.pieces.items()
            if len(piece) > 1 and self.single.issuperset(piece) and self.viterbi(piece)[1] > score + 1e-3 * abs(score) + 1e-6
        ]
        for piece in beaten:
            self.automaton.remove_word(piece)
        if beaten:
            self.automaton.make_automaton()

    def viterbi(self, chunk: str) -> tuple[int, float]:
        """Number of tokens and score of the best segmentation."""
        if not self.single.issuperset(chunk):
            return self._with_unknown(chunk)
        best, pieces = [0.0] + [-inf] * len(chunk), [0] * (len(chunk) + 1)
        for end, (length, score) in self.automaton.iter(chunk):  # of one end, the longest match comes first
            start = end + 1 - length
            value = best[start] + score
            if value > best[end + 1]:
                best[end + 1] = value
                pieces[end + 1] = pieces[start] + 1
        return pieces[-1], best[-1]

    def _with_unknown(self, chunk: str) -> tuple[int, float]:
        n, single, unknown = len(chunk), self.single, self.unknown
        best, pieces, open_run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if self.vocabulary.pieces:
            for end, match in self.automaton.iter(chunk):
                ends[end].append(match)
        by_bytes = self.vocabulary.bytes_known
        for end in range(n):
            top, count, runs, at = None, 0, False, -1
            for length, score in ends[end]:
                start = end + 1 - length
                value = best[start] + score
                if top is None or value > top or (value == top and start < at):
                    top, count, runs, at = value, pieces[start] + 1, False, start
            if chunk[end] not in single:
                value = best[end] + unknown
                if top is None or value > top:
                    more = len(chunk[end].encode("utf-8", "replace")) if by_bytes else int(not open_run[end])
                    top, count, runs = value, pieces[end] + more, True
            best[end + 1], pieces[end + 1], open_run[end + 1] = top, count, runs
        return pieces[n], best[n]

    def word(self, spaced: str) -> int:
        """Tokens of a part that no piece leaves.  It is cut on between characters that no piece has in a row."""
        inner, tokens, at = self.inner, 0, 0
        for i in range(1, len(spaced) + 1):
            if i == len(spaced) or spaced[i - 1 : i + 1] not in self.together:
                part = spaced[at:i]
                at = i
                found = inner.get(part)
                if found is None:
                    found = self.viterbi(part)[0]
                    if len(part) <= 64:
                        if len(inner) >= REMEMBERED:
                            inner.clear()
                        inner[part] = found
                tokens += found
        return tokens

    def count(self, text: str) -> int:
        """Number of tokens of a whole text; 0 for an empty one."""
        if not text:
            return 0
        prefix = SPACE if self.vocabulary.prefix_space else ""
        if self.vocabulary.joined or not self.vocabulary.bytes_known:
            return self.viterbi(prefix + text.replace(" ", SPACE))[0]
        words = text.split(" ")
        if not prefix or "" in words or SPACE in text:  # spaces in a row, or at an end
            return self.word(prefix + text.replace(" ", SPACE))
        known = self.known
        if len(known) >= REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self.word(SPACE + word)
        return sum(map(known.__getitem__, words))


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens for every row; whole texts.

    A null or empty text has 0 tokens.  Repeated rows stay, other columns are not looked at,
    an empty table gives no rows.
    """
    shared = share(docs.sparkSession, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared())
        for batch in batches:
            found = pa.array([counter.count(t or "") for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.record_batch([batch.column(0), found], names=["doc_id", "n_tokens"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {ids}, n_tokens long")
