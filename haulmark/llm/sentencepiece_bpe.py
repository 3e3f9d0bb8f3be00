"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

The words of a batch that a worker has not met yet are laid out in one flat array of symbols.  Every round finds the
best-ranked pair of each word with a segmented minimum, merges its leftmost non-overlapping occurrences in all words at
once, and compacts; words without a mergeable pair leave the array.  Pairs and ranks come from the model file, whose
path is a parameter; the file must lie at that path on every executor.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import id_and_text, map_arrow, slices

SPACE = "▁"
#: Words in a worker's table after which it starts anew, so that its memory is bounded.
WORDS_KEPT = 100_000
_NONE = np.iinfo(np.int32).max
#: Bytes of text encoded and ids decoded at a time.
_ENCODED_AT_ONCE = 250_000
_DECODED_AT_ONCE = 250_000


class Pieces:
    """The bytes that each id of one model stands for: all that decoding needs."""

    def __init__(self, path: str):
        self._read(sentencepiece.SentencePieceProcessor(model_file=path))

    def _read(self, library: sentencepiece.SentencePieceProcessor) -> None:
        self.size = size = len(library)
        pieces = [library.id_to_piece(i) for i in range(size)]
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        byte_of = {self.byte_ids[b]: bytes([b]) for b in range(256)}
        self.plain = [
            b"" if library.is_control(i) else " ⁇ ".encode() if library.is_unknown(i)
            else byte_of.get(i) or pieces[i].replace(SPACE, " ").encode() for i in range(size)
        ]
        self.starts_with_space = np.array([p.startswith(SPACE) for p in pieces])
        self.control = np.array([library.is_control(i) for i in range(size)])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: control ids vanish, an unknown id becomes its sign, broken UTF-8 one sign per byte."""
        data = b"".join(map(self.plain.__getitem__, ids.tolist()))
        visible = np.flatnonzero(~self.control[ids])
        if len(visible) and self.starts_with_space[ids[visible[0]]]:
            data = data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return re.sub("[\udc80-\udcff]", "�", data.decode("utf-8", "surrogateescape"))


class BpeModel(Pieces):
    """Tables of one model: pieces, merge ranks and the bytes each id stands for."""

    def _read(self, library: sentencepiece.SentencePieceProcessor) -> None:
        super()._read(library)
        size = self.size
        if size > 46_340:
            raise ValueError("pairs of ids must fit 31 bits")
        self.bos, self.eos = library.bos_id(), library.eos_id()
        pieces = [library.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (
            library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        self.ids = {pieces[i]: i for i in normal}
        self.char_id = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        scores = np.array([library.get_score(i) for i in range(size)])
        values, ranks, counts = np.unique(-scores[normal], return_inverse=True, return_counts=True)
        self.rank = np.full(size + 1, _NONE, np.int32)
        self.rank[normal] = ranks
        # Ranks that several pieces share: there one merge at a time decides what can be merged next.
        self.shared = np.append(counts > 1, False)
        # Plain numbers: a dict of them takes many times the memory, in every worker at once.
        keys, wholes = array("i"), array("i")
        for piece, whole in self.ids.items():
            for i in range(1, len(piece)):
                left, right = self.ids.get(piece[:i]), self.ids.get(piece[i:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    wholes.append(whole)
        order = np.argsort(np.array(keys, np.int32))
        self.pair_keys, self.pair_whole = np.array(keys, np.int32)[order], np.array(wholes, np.int32)[order]
        # Characters that occur in no longer piece stand alone, and no piece goes on from another character to a space.
        joined = {c for piece in self.ids if len(piece) > 1 for c in piece}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("pieces with a space inside are not supported")
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        self.word = re.compile(rf"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.known: dict[str, bytes] = {}

    def _pairs(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the symbols at these places make together with the one after them, ``size`` if nothing."""
        follow = np.minimum(at + 1, len(symbols) - 1)
        left, right = symbols[at], symbols[follow]
        free = (follow > at) & (word[at] == word[follow]) & (left >= 0) & (right >= 0)
        keys = np.where(free, left * np.int32(self.size) + right, 0)
        found = np.searchsorted(self.pair_keys, keys)
        found[found == len(self.pair_keys)] = 0
        return np.where(free & (self.pair_keys[found] == keys), self.pair_whole[found], np.int32(self.size))

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit numbers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int32)
        symbols = self.char_id[points]
        # Unknown characters are numbered below zero and never merge.
        symbols = np.where(symbols < 0, -1 - points, symbols)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        whole = self._pairs(symbols, word, np.arange(len(symbols)))
        done_symbols, done_words = [], []
        while len(symbols):
            rank = self.rank[whole]
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            spans = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            live = best < _NONE
            if not live.all():
                rest = np.repeat(live, spans)
                done_symbols.append(symbols[~rest])
                done_words.append(word[~rest])
                symbols, word, rank, whole = symbols[rest], word[rest], rank[rest], whole[rest]
                if not len(symbols):
                    break
                best, spans = best[live], spans[live]
                starts = np.cumsum(spans) - spans
            hit = rank == np.repeat(best, spans)
            single = self.shared[best]
            if single.any():
                place = np.arange(len(symbols))
                first = np.minimum.reduceat(np.where(hit, place, _NONE), starts)
                hit &= ~np.repeat(single, spans) | (place == np.repeat(first, spans))
            # Of overlapping occurrences every other one, from the left.
            at = np.flatnonzero(hit)
            turn = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.append(True, np.diff(at) != 1), turn, 0))
            at = at[(turn - run) % 2 == 0]
            symbols[at] = whole[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, whole = symbols[keep], word[keep], whole[keep]
            # Only pairs with a new symbol change.
            now = at - np.arange(len(at))
            changed = np.zeros(len(symbols), bool)
            changed[now] = True
            changed[np.maximum(now, 1) - 1] = True
            again = np.flatnonzero(changed)
            whole[again] = self._pairs(symbols, word, again)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        symbols, counts = symbols[order], np.bincount(word, minlength=len(words))
        missing = np.flatnonzero(symbols < 0)
        if len(missing):
            spelled = [[self.byte_ids[b] for b in chr(-1 - code).encode()] for code in symbols[missing].tolist()]
            widths = np.ones(len(symbols), np.int64)
            widths[missing] = [len(ids) for ids in spelled]
            counts = np.add.reduceat(widths, np.cumsum(counts) - counts)
            symbols = np.repeat(symbols, widths)
            symbols[symbols < 0] = [i for ids in spelled for i in ids]
        packed = symbols.astype("<u4").tobytes()
        ends = (np.cumsum(counts) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end ids, as little-endian 32-bit numbers."""
        split = [self.word.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        fresh = [w for w in set().union(*split) if w not in self.known]
        if fresh:
            self.known.update(zip(fresh, self.merge_words(fresh)))
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.bos, self.eos))
        get = self.known.__getitem__
        return [b"".join([begin, *map(get, words), end]) for words in split]


@lru_cache(maxsize=2)
def load(path: str) -> BpeModel:
    """One model per worker process."""
    return BpeModel(path)


@lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    """What decoding needs of a model, without the tables for encoding; one per worker process."""
    return Pieces(path)


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``ids array<int>`` of every row's whole text, begin and end ids included.

    A null text counts as empty (begin and end id only).  One row per input row: repeated rows and null ids included;
    an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = load(model)
        for part in (part for batch in batches for part in slices(batch, size=_ENCODED_AT_ONCE)):
            packed = bpe.encode([t or "" for t in part["text"].to_pylist()])
            offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            values = np.frombuffer(b"".join(packed), "<i4")
            yield {"id": part["id"], "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}

    return map_arrow(id_and_text(df, id_col, text_col), run, "id bigint, ids array<int>")


def _texts(model: str):
    """Texts of an Arrow batch of ids, a slice at a time: as Python strings a batch takes several times its memory."""
    def run(ids: pa.Array) -> pa.Array:
        pieces, texts = load_pieces(model), [pa.array([], pa.string())]
        for part in slices(pa.RecordBatch.from_arrays([ids], ["ids"]), "ids", size=_DECODED_AT_ONCE):
            rows = (np.asarray(row.values if row.is_valid else [], np.int64) for row in part["ids"])
            texts.append(pa.array([pieces.decode(row) for row in rows], pa.string()))
        return pa.concat_arrays(texts)

    return run


def decode(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids in ``text_col``; null or no ids give an empty text."""
    return df.withColumn(text_col, F.arrow_udf(_texts(model), "string")(F.col(ids_col)))
