"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton enumerates the pieces that end at each character; the dynamic programme carries the best score
and the number of pieces, never the pieces. Ties go as in the tokenizer: a path replaces another only if its score is
strictly larger, and paths to a place are tried from the earliest start on. A character that is no piece of its own may
be unknown, at the lowest score of the vocabulary less ten; neighbouring unknowns are one token, or one per byte where
the vocabulary falls back to bytes.

A text starts with a word mark and has one for each space. Where no piece holds a mark behind another character, and
the mark is itself a piece, no best path crosses from a word into the next mark, so words are counted one by one and
remembered. Scores are kept to multiples of a power of two, so that sums, and ties, are exact either way.

A file whose pieces are ranked by merges has no log probabilities. They are then taken from the ranks by Zipf's law, a
fixed rule: nothing is trained.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm.memory import lean, small_batches

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]*")
#: Score of an unknown character below the lowest piece, words remembered, and their longest length.
PENALTY, REMEMBERED, LONGEST = 10.0, 300_000, 64
ROWS = 256

#: Scores are whole multiples of this.
GRAIN = 2.0**-20

Counts = tuple[int, float, int]  # tokens, score, unknown characters


def zipf(rank: int, size: int) -> float:
    """Log probability of the piece with that rank, from 1, of ``size``: proportional to one over the rank."""
    return -math.log(rank) - math.log(math.log(size) + 0.5772156649015329)


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Pieces that text can match, with their log probabilities, of a sentencepiece model file; and whether it falls back to bytes.

    Control, byte, unused and unknown pieces match no text. Whole scores below -1000 are ranks of merges.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unused(i) or model.is_unknown(i))]
    scores = {i: float(model.get_score(i)) for i in plain}
    if scores and min(scores.values()) < -1000 and all(s == int(s) for s in scores.values()):
        order = sorted(plain, key=lambda i: (-scores[i], i))
        scores = {i: zipf(rank, len(order)) for rank, i in enumerate(order, 1)}
    return [(model.id_to_piece(i), round(scores[i] / GRAIN) * GRAIN) for i in plain], any(map(model.is_byte, ids))


class Viterbi(dict):
    """Counts tokens; as a dict it remembers the counts of words."""

    def __init__(self, vocabulary: list[tuple[str, float]], to_bytes: bool = False):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        pieces = {piece for piece, _ in vocabulary}
        self.unknown = min(score for _, score in vocabulary) - PENALTY
        self.bytes = to_bytes
        self.by_word = MARK in pieces and not any(MARK in piece.lstrip(MARK) for piece in pieces)

    def count_run(self, text: str) -> Counts:
        n = len(text)
        score, tokens, unknown = [0.0] + [None] * n, [0] * (n + 1), [0] * (n + 1)
        was_unknown = [False] * (n + 1)
        done = 0

        def step(end: int, single: bool) -> None:
            """The unknown edge into ``end``, which comes after all pieces that end there."""
            if single:
                return
            start = end - 1
            if score[end] is None or score[start] + self.unknown > score[end]:
                score[end] = score[start] + self.unknown
                if self.bytes:
                    tokens[end] = tokens[start] + len(text[start].encode("utf-8", "surrogatepass"))
                else:
                    tokens[end] = tokens[start] + (not was_unknown[start])
                unknown[end] = unknown[start] + 1
                was_unknown[end] = True

        single = False
        for last, (length, gain) in self.automaton.iter(text):  # by end, longest piece first
            end = last + 1
            while done < end - 1:
                done += 1
                step(done, single)
                single = False
            start = end - length
            if score[end] is None or score[start] + gain > score[end]:
                score[end] = score[start] + gain
                tokens[end], unknown[end], was_unknown[end] = tokens[start] + 1, unknown[start], False
            single |= length == 1
        while done < n:
            done += 1
            step(done, single)
            single = False
        return tokens[n], score[n], unknown[n]

    def __missing__(self, word: str) -> Counts:
        found = self.count_run(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def count(self, text: str) -> Counts:
        if not text:
            return 0, 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.count_run(marked)
        tokens, score, unknown = zip(*map(self.__getitem__, filter(None, WORD.findall(marked))))
        return sum(tokens), sum(score), sum(unknown)


@lru_cache(maxsize=2)
def counter(path: str) -> Viterbi:
    return Viterbi(*read_vocabulary(path))


def _count(path: str):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        viterbi = counter(path)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                tokens, score, unknown = zip(*(viterbi.count(t or "") for t in part["raw"].to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part["doc"], pa.array(tokens, pa.int64()), pa.array(score, pa.float64()), pa.array(unknown, pa.int64())],
                    names=["doc", "n_tokens", "score", "n_unknown"],
                )

    return run


def count_tokens(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``score`` of the best path, ``n_unknown`` characters.

    ``vocabulary`` is the path of a sentencepiece model file, whose pieces are taken as a unigram vocabulary
    (:func:`read_vocabulary`). Null and empty texts have no tokens. Repeated rows are counted each, a null id stays null, an empty
    table gives an empty result, and other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("raw"))
    shape = f"doc {base.schema['doc'].dataType.simpleString()}, n_tokens long, score double, n_unknown long"
    return base.mapInArrow(_count(vocabulary), shape).withColumnRenamed("doc", id_col)
