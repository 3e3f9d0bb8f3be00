"""Token ids in binary files of directly addressable codes.

An id is split into chunks of a few bits, lowest first.  Level 0 of a file holds the first chunk of every id, with one
bit telling whether the id goes on; level 1 holds the second chunks of those that do, and so on.  A directory counts the
set bits before every 512th one, so the place of an id's next chunk is a rank: any token is found by a handful of small
reads, and no block is decoded for it.  Widths are those that make the file smallest, given how many bits its ids need.

A file: ``MAGIC``, length of the header (4 bytes), header (JSON: counts, and place and length of each section), sections.
Everything is little-endian; chunks and bitmaps are packed from the lowest bit on.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import id_and_text, map_arrow, slices, text_key
from haulmark.operators.ordered import running_sum
from haulmark.session import new_folder, pin
from haulmark.sources.filesystem import make_dir, reading, writing

#: A file is closed once it holds so many ids.
TOKENS_PER_FILE = 1 << 24
#: Words after which a worker's table grows old; it holds twice as many at most.
WORDS_KEPT = 400_000
#: Ids that are unpacked at a time.
SEGMENT = 1 << 18

# Fixed values of the format.
MAGIC = b"DACIDS01"
RANK_EVERY = 512
#: Eight chunks fit into 64 bits.
WIDEST = 8

FILE = "part int, seq int, file string, n_docs bigint, n_tokens bigint, n_bytes bigint"

_BLANK = "\\s\u180e\u200b\ufeff"
_BEFORE_WORD = re.compile(f"(?= [^{_BLANK}])")
#: Letters of the Latin alphabets; what follows them is a word of its own if it is no letter.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_AFTER_LETTERS = re.compile(f"(?<=[{_LETTERS}])(?=[!-/:-@\\[-`{{-~\\s])")
_WORD = re.compile(f" ?[{_LETTERS}]+")
#: Where this is found, a text is not as plain as ``_plain_pieces`` wants it.
_NOT_PLAIN = re.compile(f"[{_BLANK}][{_BLANK}]|(?<![{_LETTERS}0-9])[.,]|\x00")


def _plain_pieces(text: str) -> list[str]:
    """Cut before single spaces, around single newlines, and before a full stop or comma after a letter or digit."""
    marked = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").replace(".", "\x00.").replace(",", "\x00,")
    return marked.split("\x00")


def _byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level models: printable ones for themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Words(dict):
    """Ids, as bytes, of words with what stands before each.

    When the table is full it becomes the older half, which gives its words back when they are asked for again: words
    that come often stay.
    """

    def __init__(self, ids: Callable[[str], bytes]):
        super().__init__()
        self.ids, self.older = ids, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.ids(word)
        if len(self) >= WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Ids of a text as the ``tokenizers`` library gives them.

    Byte-level models cut a text into words before they look at a word's bytes: always before a space that something else
    than white space follows, and between a letter and what is none.  So the library's model is asked
    once for each word, and their ids are joined.  Models of any other kind encode whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        model = json.loads(self.library.to_str())
        self.by_words = self._cuts_at_spaces(model)
        self.added = [t["content"] for t in model.get("added_tokens", [])]
        self.alphabet, self.tokenize = _byte_alphabet(), self.library.model.tokenize
        self.words = _Words(self._word)

    @staticmethod
    def _cuts_at_spaces(model: dict) -> bool:
        cut = model.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("normalizer", "truncation", "padding")) and not model["model"].get("dropout")
        byte_level = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        added = all(not re.search(r"\s", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                    for t in model.get("added_tokens", []))
        return bool(plain and byte_level and added)

    def _word(self, text: str) -> bytes:
        if not _WORD.fullmatch(text):
            return self._whole(text)
        # One word is for the model itself, without what would look for words.
        spelt = text.replace(" ", self.alphabet[32]) if text.isascii() else text.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenize(spelt)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as unsigned 32-bit integers."""
        if not self.by_words or any(token in text for token in self.added):
            return self._whole(text)
        if not _NOT_PLAIN.search(text):
            pieces = _plain_pieces(text)
        else:
            pieces = [piece for word in _BEFORE_WORD.split(text) for piece in _AFTER_LETTERS.split(word)]
        return b"".join(map(self.words.__getitem__, pieces))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of all levels that take the fewest bits, continuation bits and rank directory included."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if top <= 24:
        by_id = np.bincount(ids, minlength=1)
        bits = np.add.reduceat(by_id, [0, *[1 << b for b in range(top) if 1 << b < len(by_id)]])
    else:
        bits = np.bincount(np.frexp(ids.astype(np.float64))[1], minlength=1)
    longest = max(1, len(bits) - 1)
    # Ids that reach the level that begins at bit s.
    reach = [len(ids), *(len(ids) - np.cumsum(bits))[1:].tolist()]
    cost: dict[int, tuple[float, list[int]]] = {longest: (0.0, [])}
    for s in range(longest - 1, -1, -1):
        cost[s] = min(
            (reach[s] * (w + (1 + 32 / RANK_EVERY if s + w < longest else 0)) + cost[s + w][0], [w, *cost[s + w][1]])
            for w in range(1, min(WIDEST, longest - s) + 1)
        )
    return cost[0][1]


def _pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits one after the other: eight of them fill ``width`` bytes of a 64-bit word."""
    eights = np.zeros((-(-len(values) // 8), 8), np.uint64)
    eights.reshape(-1)[:len(values)] = values
    words = eights[:, 0].copy()
    for i in range(1, 8):
        words |= eights[:, i] << np.uint64(i * width)
    return words.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    """All values of whole groups of eight."""
    groups = len(data) // width
    padded = np.zeros((groups, 8), np.uint8)
    padded[:, :width] = np.frombuffer(data, np.uint8).reshape(groups, width)
    words, mask = padded.view("<u8").ravel(), np.uint64((1 << width) - 1)
    out = np.empty((groups, 8), np.uint32)
    for i in range(8):
        out[:, i] = (words >> np.uint64(i * width)) & mask
    return out.reshape(-1)


def file_bytes(ids: np.ndarray, doc_ids: list[int | None], ends: list[int]) -> bytes:
    """A whole file: all ids of some documents, and where each document ends."""
    sections, at, levels, left = [], 0, [], ids.astype(np.uint32)

    def add(data: bytes) -> list[int]:
        nonlocal at
        sections.append(data)
        at += len(data)
        return [at - len(data), len(data)]

    widths = best_widths(ids)
    for level, width in enumerate(widths):
        entry = {"width": width, "count": len(left),
                 "chunks": add(_pack(left & np.uint32((1 << width) - 1), width))}
        if level + 1 < len(widths):
            left = left >> np.uint32(width)
            more = left != 0
            before = np.zeros(len(more) // RANK_EVERY + 1, "<u4")
            whole = more[:len(more) // RANK_EVERY * RANK_EVERY].reshape(-1, RANK_EVERY)
            before[1:] = np.cumsum(whole.sum(axis=1))
            entry |= {"more": add(np.packbits(more, bitorder="little").tobytes()), "ranks": add(before.tobytes())}
            left = left[more]
        levels.append(entry)
    header = json.dumps({
        "tokens": len(ids), "docs": len(doc_ids), "levels": levels,
        "doc_ids": add(np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes()),
        "doc_nulls": add(np.packbits([i is None for i in doc_ids], bitorder="little").tobytes()),
        "doc_ends": add(np.array(ends, "<u8").tobytes()),
    }).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *sections])


class TokenFile:
    """Reads a file through ``read(start, length)``: of an open file, or of bytes in memory."""

    def __init__(self, read: Callable[[int, int], bytes]):
        start = read(0, len(MAGIC) + 4)
        if start[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(start[len(MAGIC):], "little")
        self.header = json.loads(read(len(start), size))
        self._read, self._base = read, len(start) + size

    def _section(self, place: list[int], start: int = 0, length: int | None = None) -> bytes:
        length = place[1] - start if length is None else max(0, min(length, place[1] - start))
        return self._read(self._base + place[0] + start, length)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the documents, and the end of each among the file's tokens."""
        count = self.header["docs"]
        ids = np.frombuffer(self._section(self.header["doc_ids"]), "<i8").tolist()
        nulls = np.unpackbits(np.frombuffer(self._section(self.header["doc_nulls"]), np.uint8), count=count, bitorder="little")
        return [None if n else i for i, n in zip(ids, nulls)], np.frombuffer(self._section(self.header["doc_ends"]), "<u8").astype(np.int64)

    def _rank(self, level: dict, place: int) -> int:
        """Ids of a level before ``place`` that go on."""
        block = place // RANK_EVERY
        before = int.from_bytes(self._section(level["ranks"], 4 * block, 4), "little")
        bits = np.frombuffer(self._section(level["more"], block * RANK_EVERY // 8, RANK_EVERY // 8), np.uint8)
        return before + int(np.unpackbits(bits, bitorder="little")[:place - block * RANK_EVERY].sum())

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Ids at the places from ``begin`` up to ``end``, whatever stands before them."""
        count = self.header["tokens"]
        if not 0 <= begin <= end <= count:
            raise IndexError(f"places {begin} to {end} of {count}")
        out = np.zeros(end - begin, np.uint32)
        places, shift = np.arange(end - begin), 0
        for level in self.header["levels"]:
            if begin == end:
                break
            width = level["width"]
            group = begin // 8
            chunks = _unpack(self._section(level["chunks"], group * width, (-(-end // 8) - group) * width), width)
            out[places] |= chunks[begin - 8 * group:end - 8 * group] << np.uint32(shift)
            if "more" in level:
                first = begin // 8
                bits = np.frombuffer(self._section(level["more"], first, (end + 7) // 8 - first), np.uint8)
                more = np.unpackbits(bits, bitorder="little")[begin - 8 * first:end - 8 * first].astype(bool)
                begin = self._rank(level, begin)
                places = places[more]
                end = begin + len(places)
            shift += width
        return out


def _from_memory(data: bytes) -> TokenFile:
    return TokenFile(lambda start, length: data[start:start + length])


def _write_files(folder: str, model: str, end_id: int | None, tokens_per_file: int):
    last = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task, seq = TaskContext.get().partitionId(), 0
        pieces, docs, ends, held = [], [], [], 0

        def close() -> dict:
            # A task that runs again writes another file; only files named in the stored table count.
            path = f"{folder}/{uuid.uuid4().hex}.dac"
            data = file_bytes(np.frombuffer(b"".join(pieces), "<u4"), docs, ends)
            with writing(path) as out:
                out.write(data)
            return {"part": [task], "seq": [seq], "file": [path], "n_docs": [len(docs)], "n_tokens": [held], "n_bytes": [len(data)]}

        for batch in batches:
            for part in slices(batch):
                for key, text in zip(part["id"].to_pylist(), part["text"].to_pylist()):
                    ids = encoder(model).ids(text or "") + last
                    pieces.append(ids)
                    held += len(ids) // 4
                    docs.append(key)
                    ends.append(held)
                    if held >= tokens_per_file:
                        yield close()
                        pieces, docs, ends, held, seq = [], [], [], 0, seq + 1
        if docs:
            yield close()

    return run


def write_token_files(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 0,
                      tokens_per_file: int = TOKENS_PER_FILE) -> DataFrame:
    """Encode whole texts and write their ids in ascending order of id; one row per file (``FILE`` and ``start``).

    ``model`` is the path of a ``tokenizers`` file; ``end_id`` follows each document (None: nothing does).  Texts are
    range-partitioned by id; a task encodes its range in order and writes files of about ``tokens_per_file`` ids each, so
    its memory does not depend on the size of a range.  ``start`` is the number of ids in all files before.

    * null or empty text: only the end id;
    * null id: kept, before all others;
    * repeated ids: ordered by a hash of the text; repeated rows: each is written;
    * empty table: no files.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "token-files")
    make_dir(folder)
    rows = id_and_text(df, id_col, text_col).withColumn("row", text_key("text"))
    ordered = rows.repartitionByRange("id", "row").sortWithinPartitions("id", "row")
    files = pin(map_arrow(ordered, _write_files(folder, model, end_id, tokens_per_file), FILE), "token-file-list")
    placed = running_sum(files, F.col("n_tokens"), ["part", "seq"], name="end")
    return placed.withColumn("start", F.col("end") - F.col("n_tokens")).drop("end")


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for path, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist()):
            with reading(path) as stream:
                found = _from_memory(stream.read())
            docs, ends = found.documents()
            begins = np.append(0, ends[:-1]).astype(np.int64)
            at = 0
            while at < len(docs):
                # About a segment of ids at a time, but whole documents.
                stop = max(at + 1, int(np.searchsorted(ends, begins[at] + SEGMENT, "right")))
                ids = found.tokens(int(begins[at]), int(ends[stop - 1]))
                cut = [ids[b:e] for b, e in zip((begins[at:stop] - begins[at]).tolist(), (ends[at:stop] - begins[at]).tolist())]
                yield {"id": docs[at:stop], "start": start + begins[at:stop], "n_tokens": ends[at:stop] - begins[at:stop],
                       "ids": cut, "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in cut]}
                at = stop


def read_token_files(files: DataFrame, ids: bool = True) -> DataFrame:
    """All documents of the files: ``id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` and,
    if asked for, ``ids`` (array<bigint>).  Each file is read by one task."""
    # A fixed number of tasks: to adaptive execution a few paths are one partition, whatever the files hold.
    tasks = 4 * files.sparkSession.sparkContext.defaultParallelism
    columns = "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if ids else "")
    return map_arrow(files.select("file", "start").repartition(tasks, "file"), _read_documents, columns)


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        rows = sorted(zip(batch["file"].to_pylist(), batch["place"].to_pylist(), batch["position"].to_pylist()))
        path, stream, opened, out = None, None, None, []
        for file, place, position in rows:
            if file != path:
                if opened is not None:
                    opened.__exit__(None, None, None)
                opened, path = reading(file), file
                stream = opened.__enter__()
                found = TokenFile(lambda start, length, s=stream: (s.seek(start), s.read(length))[1])
            out.append((position, int(found.tokens(place, place + 1)[0])))
        if opened is not None:
            opened.__exit__(None, None, None)
        if out:
            yield dict(zip(("position", "token_id"), zip(*out)))


def tokens_at(files: DataFrame, positions: DataFrame, position_col: str = "position",
              tokens_per_bucket: int = TOKENS_PER_FILE) -> DataFrame:
    """The token at each distinct position of the whole collection: ``position``, ``token_id``.

    Files are found by equal buckets of positions; of a file only a few bytes per token are read.  A position that is
    null or outside the collection gives no row.
    """
    asked = positions.select(F.col(position_col).cast("bigint").alias("position")).filter("position >= 0").distinct()
    asked = asked.withColumn("bucket", F.expr(f"position div {tokens_per_bucket}"))
    spans = files.filter("n_tokens > 0").select("file", "start", "n_tokens", F.explode(F.expr(
        f"sequence(start div {tokens_per_bucket}, (start + n_tokens - 1) div {tokens_per_bucket})")).alias("bucket"))
    found = asked.join(spans, "bucket").filter("position >= start AND position < start + n_tokens")
    return map_arrow(found.select("file", (F.col("position") - F.col("start")).alias("place"), "position"), _look_up,
                     "position bigint, token_id bigint")
