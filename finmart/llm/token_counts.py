"""Token counts of a unigram tokenizer without building tokens: Aho-Corasick and a count-only Viterbi.

The pieces and scores of a vocabulary file are read as a unigram model. An automaton lists all
pieces that end at each character; dynamic programming keeps, per end, only the best score and
the number of pieces on its path. Rules of ties and unknown characters are those of the
unigram model of the tokenizers library: of equal scores the path whose last piece starts
first wins; a character that is no piece costs the least score of the vocabulary less ten,
and counts as many byte pieces as its UTF-8 form has bytes.

White space is written as U+2581, one more stands before the text. No piece has that mark after
another character, so every path breaks before a word and words are solved, and remembered,
apart. Scores are whole numbers in double precision, so this changes no comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from finmart.llm.byte_bpe import read_text
from finmart.llm.tables import long_id

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words remembered per worker process, in two generations, and the longest of them.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64

#: Marks open a chunk; a line feed, which is no piece, is a chunk of its own.
_CHUNK = regex.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces that can match text; reserved ones (unknown, control, single bytes) never do."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
    ]


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        best: dict[str, float] = {}
        for piece, score in pieces:
            if piece:
                best[piece] = score  # of equal pieces the last one counts
        for piece, score in best.items():
            self.automaton.add_word(piece, (len(piece), score))
        if best:
            self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.apart = not any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in best)
        self.young: dict[str, tuple[int, float]] = {}
        self.old: dict[str, tuple[int, float]] = {}

    def solve(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path over ``text`` as it stands."""
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if len(self.automaton):
            for end, match in self.automaton.iter(text):
                ends[end].append(match)
        scores, counts = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            best, start, count, single = None, end, 0, False
            for length, score in ends[end]:
                single = single or length == 1
                at = end + 1 - length
                total = scores[at] + score
                if best is None or total > best or (total == best and at < start):
                    best, start, count = total, at, counts[at] + 1
            if not single:
                total = scores[end] + self.unknown
                if best is None or total > best:
                    best, count = total, counts[end] + len(text[end].encode("utf-8", "surrogatepass"))
            scores[end + 1], counts[end + 1] = best, count
        return counts[n], scores[n]

    def _word(self, word: str) -> tuple[int, float]:
        found = self.old.get(word) or self.solve(word)
        if len(word) <= LONGEST_REMEMBERED:
            self.young[word] = found
        return found

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        if not self.apart:
            return self.solve(marked)
        young, pieces, score = self.young, 0, 0.0
        for chunk in _CHUNK.findall(marked):
            c, s = young.get(chunk) or self._word(chunk)
            pieces += c
            score += s
        if len(young) > REMEMBERED:
            self.old, self.young = young, {}
        return pieces, score


_COUNTERS: dict[str, UnigramCounter] = {}


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:  # one per worker process and vocabulary
            _COUNTERS[path] = UnigramCounter(read_pieces(path))
        counter = _COUNTERS[path]
        for batch in batches:
            found = [counter.count(read_text(text)) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "n_tokens", "best_score"])

    return run


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, best_score)`` for every row of ``docs``.

    A NULL or empty text has no tokens and score 0. NULL ids and repeated rows are counted like
    others; other columns are not read.
    """
    return docs.select(
        long_id(F.col(doc_id)).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    ).mapInArrow(_count(vocabulary or public_tokenizers.path(VOCABULARY)), "doc_id long, n_tokens long, best_score double")
