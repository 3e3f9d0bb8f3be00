"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character of a word; dynamic programming over
the characters carries only the best score and its number of pieces, no segmentation.  Rules are those of the
``tokenizers`` library's unigram model with byte fallback behind a ``Metaspace`` splitter: a text gets a leading space
sign unless it has one, words begin at space signs, of equal scores the piece that begins first wins, a character
without a piece of its own costs the smallest score less 10 and counts its UTF-8 bytes.

Words are independent, so a worker looks each word up in a bounded table and runs the program for new ones only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from haulmark.llm.common import id_and_text, map_arrow, slices

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
WORDS_KEPT = 300_000
_WORD = re.compile(f"{SPACE}[^{SPACE}]*")


def piece_scores(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, without control, unknown and byte pieces."""
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (library.id_to_piece(i), library.get_score(i)) for i in range(len(library))
        if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
    ]


class UnigramCounter(dict):
    """(pieces, score) of a word that begins with the space sign."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        best, pieces = [0.0], [0]
        matches = self.automaton.iter(word)
        end, piece = next(matches, (len(word), None))
        for at, char in enumerate(word):
            score, count, single = None, 0, False
            # The automaton lists the pieces that end here from the longest, that is from the earliest start.
            while end == at:
                length, own = piece
                if score is None or best[at + 1 - length] + own > score:
                    score, count = best[at + 1 - length] + own, pieces[at + 1 - length] + 1
                single = single or length == 1
                end, piece = next(matches, (len(word), None))
            if not single and (score is None or best[at] + self.unknown > score):
                score, count = best[at] + self.unknown, pieces[at] + len(char.encode())
            best.append(score)
            pieces.append(count)
        self[word] = found = pieces[-1], best[-1]
        return found

    def count(self, text: str) -> tuple[int, int, float]:
        """Number of pieces and of words, and the sum of the words' best scores."""
        marked = text.replace(" ", SPACE)
        if marked and not marked.startswith(SPACE):
            marked = SPACE + marked
        found = list(map(self.__getitem__, _WORD.findall(marked)))
        return sum(n for n, _ in found), len(found), sum((s for _, s in found), 0.0)


@lru_cache(maxsize=2)
def load(path: str) -> UnigramCounter:
    """One counter per worker process."""
    return UnigramCounter(piece_scores(path))


def count_tokens(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_tokens``, ``n_words`` and ``score`` of every row's whole text.

    ``model`` is the path, on every executor, of the file with pieces and scores.  A null or empty text has no tokens
    and score 0.  One row per input row, repeated rows and null ids included; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counter = load(model)
        for batch in batches:
            for part in slices(batch):
                counts = [counter.count(t or "") for t in part["text"].to_pylist()]
                tokens, words, scores = zip(*counts)
                yield {"id": part["id"], "n_tokens": tokens, "n_words": words, "score": scores}

    return map_arrow(id_and_text(df, id_col, text_col), run, "id bigint, n_tokens bigint, n_words bigint, score double")
