"""Substring deduplication with repeated-phrase automata.

A passage repeats if a window of ``WINDOW`` consecutive words of it occurs in several documents.

1. *Find.*  Every window has an anchor, the run of ``ANCHOR`` words in it with the smallest hash; equal windows have equal
   anchors.  Neighbouring windows share anchors, so a document has about one anchor per 20 words.  Anchors that one
   document only holds are out.
2. *Confirm.*  All windows of one anchor in a document are one stretch.  Equal stretches are counted as one; only where
   an anchor has different stretches are their windows compared one by one.  Each recurring window belongs to the
   smallest document that holds it; consecutive ones of a document are a recurring passage.
3. *Locate.*  Documents are dealt into small shards by a hash of their id.  A stretch has few windows, and each of them
   one owner, so a stretch leads to few passages, however many documents share its anchor.  A shard gets, once each, the
   passages that the stretches of its documents lead to, compiles their anchors into an Aho-Corasick automaton, streams
   its documents through it, and extends every hit along its diagonal, word by word: what agrees over a whole window is
   removed.

All counting is by hash aggregation with map-side combination; no group is collected, and texts are moved twice.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from math import isqrt

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import WordHashes, as_bytes, gram_hashes, id_and_text, map_arrow, mix, slices
from haulmark.session import pin

WINDOW, ANCHOR = 50, 10
#: Windows of one part of a passage.
_PART = 300
#: Documents of one shard, on average.
SHARD_DOCUMENTS = 4_000

_STRETCH = "anchor bigint, stretch bigint, id bigint, start int, n int"
_LOW = np.uint64(0xFFFFFFFF)


class Stretches:
    """Anchors of a sequence of word hashes: for each stretch its anchor's hash and place, first window and last window."""

    def __init__(self, words: np.ndarray, window: int, anchor: int):
        grams = gram_hashes(words, anchor)
        width, span = window - anchor + 1, 1
        count = len(words) - window + 1
        if count <= 0:
            self.place = self.first = self.last = np.empty(0, np.int64)
            self.anchor = np.empty(0, np.int64)
            return
        end = np.uint64(len(grams) - 1)
        # The place in the lower half makes the rightmost of equal hashes the smallest.
        low = (grams & ~_LOW) | (end - np.arange(len(grams), dtype=np.uint64))
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:span - width], low[width - span:])
        place = (end - (low & _LOW)).astype(np.int64)
        self.first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        self.last = np.append(self.first[1:], count) - 1
        self.place = place[self.first]
        self.anchor = grams[self.place].view(np.int64)

    def hashes(self, words: np.ndarray, window: int) -> list[int]:
        """64-bit hash of all words that the windows of each stretch cover."""
        data = words.tobytes()
        return [xxhash.xxh3_64_intdigest(data[8 * a:8 * (b + window)]) - 2**63
                for a, b in zip(self.first.tolist(), self.last.tolist())]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Texts, compressed: they are moved more than once."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in slices(batch):
            yield {"id": part["id"], "text": [packer.compress(t) for t in as_bytes(part["text"])]}


def _unpacked(column: pa.Array) -> list[bytes]:
    reader = zstandard.ZstdDecompressor()
    return [reader.decompress(t) if t else b"" for t in column.to_pylist()]


def _find(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                anchors, stretches, ids, starts, sizes = [], [], [], [], []
                for key, text in zip(part["id"].to_pylist(), as_bytes(part["text"])):
                    words = hashes.of(text.split())
                    found = Stretches(words, window, anchor)
                    if not len(found.anchor):
                        continue
                    own = np.array(found.hashes(words, window), np.int64)
                    # One row for a stretch that a document holds several times.
                    _, once = np.unique(mix(found.anchor.view(np.uint64)) ^ own.view(np.uint64), return_index=True)
                    anchors.append(found.anchor[once])
                    stretches.append(own[once])
                    ids.append(np.full(len(once), key, np.int64))
                    starts.append(found.first[once])
                    sizes.append((found.last - found.first + 1)[once])
                if anchors:
                    yield {"anchor": np.concatenate(anchors), "stretch": np.concatenate(stretches), "id": np.concatenate(ids),
                           "start": np.concatenate(starts).astype(np.int32), "n": np.concatenate(sizes).astype(np.int32)}

    return run


def _window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    return gram_hashes(words, window, seed=0xC2B2AE3D27D4EB4F).view(np.int64)


def _open_windows(window: int, anchor: int):
    """Every window of the stretches that a document has to compare."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                out = defaultdict(list)
                for key, text, todo in zip(part["id"].to_pylist(), _unpacked(part["text"]), part["todo"].to_pylist()):
                    words = hashes.of(text.split())
                    windows = _window_hashes(words, window)
                    for entry in todo:
                        at = np.arange(entry["start"], min(entry["start"] + entry["n"], len(windows)), dtype=np.int64)
                        out["anchor"].append(np.full(len(at), entry["anchor"], np.int64))
                        out["stretch"].append(np.full(len(at), entry["stretch"], np.int64))
                        out["window"].append(windows[at])
                        out["id"].append(np.full(len(at), key, np.int64))
                        out["last"].append(np.full(len(at), entry["last"], np.int64))
                        out["start"].append(at.astype(np.int32))
                if out:
                    yield {c: np.concatenate(v) for c, v in out.items()}

    return run


def _passages(window: int, anchor: int):
    """Recurring passages of each document, with their anchors' hashes and places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes, packer = WordHashes(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch):
                out = defaultdict(list)
                for key, text, spans in zip(part["id"].to_pylist(), _unpacked(part["text"]), part["spans"].to_pylist()):
                    words = text.split()
                    count = len(words) - window + 1
                    if count <= 0:
                        continue
                    found = Stretches(hashes.of(words), window, anchor)
                    own = np.repeat(found.anchor, found.last - found.first + 1)
                    place = np.repeat(found.place, found.last - found.first + 1)
                    recurs = np.zeros(count + 1, bool)
                    for span in spans:
                        at = np.arange(span["start"], min(span["start"] + span["n"], count))
                        # Of several texts under one id this is the one meant only if the anchor is there.
                        recurs[at[own[at] == span["anchor"]]] = True
                    edges = np.flatnonzero(np.diff(np.append(False, recurs).astype(np.int8)))
                    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        # In parts that overlap by a window, so that a document gets no more than what is near its anchors.
                        for at in range(begin, end, _PART):
                            stop = min(at + _PART, end)
                            out["owner"].append(key)
                            out["begin"].append(at)
                            out["anchors"].append(np.unique(own[at:stop]))
                            out["places"].append(np.unique(place[at:stop]) - at)
                            out["passage"].append(packer.compress(b" ".join(words[at:stop - 1 + window])))
                if out:
                    yield out

    return run


class _Codes(dict):
    """Two characters for each word of the passages; the same two for all other words."""

    def __missing__(self, word: bytes) -> str:
        return "\0\0"


class PhraseAutomaton:
    """The anchors of some passages, compiled.

    Words are spelt with two characters, the first and the second from alphabets of their own, so that no node has many
    children and nothing is found across the middle of a word.
    """

    def __init__(self, window: int, anchor: int):
        self.window, self.anchor = window, anchor
        self.half = (window - anchor + 1) // 2
        self.owners, self.passages, self.places = [], [], []
        self.numbers: dict[bytes, int] = {}
        self.codes, self.automaton = _Codes(), None

    def add(self, owner: int, text: bytes, places: list[int]) -> None:
        """A passage, and where its anchors begin."""
        self.owners.append(owner)
        self.passages.append(array("I", [self.numbers.setdefault(w, len(self.numbers)) for w in text.split()]))
        self.places.append(places)

    def compile(self) -> None:
        base = isqrt(len(self.numbers)) + 1
        spelt = [chr(1 + i // base) + chr(1 + base + i % base) for i in range(len(self.numbers))]
        self.codes = _Codes(zip(self.numbers, spelt))
        seeds: dict[str, list] = {}
        for i, words in enumerate(self.passages):
            text = self.passages[i] = "".join([spelt[w] for w in words])
            for at in self.places[i]:
                seeds.setdefault(text[2 * at:2 * (at + self.anchor)], []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for phrase, places in seeds.items():
            self.automaton.add_word(phrase, places)
        if seeds:
            self.automaton.make_automaton()
        self.numbers, self.places = {}, []

    def spell(self, words: list[bytes]) -> str:
        return "".join(map(self.codes.__getitem__, words))

    def covered(self, doc: int, words: list[bytes]) -> np.ndarray:
        """Which words lie in a window that a passage of a smaller document has too."""
        covered = np.zeros(len(words), bool)
        if not len(self.automaton) or len(words) < self.window:
            return covered
        spelt, numbers, done = self.spell(words), None, set()
        half, width = 2 * self.half, 2 * self.anchor
        for last, places in self.automaton.iter(spelt):
            # In characters: where the phrase begins and ends.
            begin, end = last + 1 - width, last + 1
            for passage, at in places:
                shift = begin // 2 - at
                if self.owners[passage] >= doc or (passage, shift) in done:
                    continue
                # A window around the anchor has half of its other words on one side.
                known, here = self.passages[passage], 2 * at
                after = known[here + width:here + width + half]
                if len(after) < half or after != spelt[end:end + half]:
                    if here < half or known[here - half:here] != spelt[max(0, begin - half):begin]:
                        continue
                done.add((passage, shift))
                if numbers is None:
                    numbers = _as_numbers(spelt)
                low, high = max(0, shift), min(len(words), shift + len(known) // 2)
                same = np.zeros(high - low + 2, bool)
                same[1:-1] = numbers[low:high] == _as_numbers(known[2 * (low - shift):2 * (high - shift)])
                turns = np.flatnonzero(same[1:] != same[:-1])
                for start, stop in zip(turns[::2].tolist(), turns[1::2].tolist()):
                    if stop - start >= self.window:
                        covered[low + start:low + stop] = True
        return covered


def _as_numbers(spelt: str) -> np.ndarray:
    """One number per word."""
    return np.frombuffer(spelt.encode("utf-32-le"), np.uint64)


def _remove(window: int, anchor: int):
    """Rows by shard, its passages before its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shard, automaton = None, None
        for part in (part for batch in batches for part in slices(batch)):
            out = defaultdict(list)
            for number, is_document, key, text, places in zip(
                    part["shard"].to_pylist(), part["is_document"].to_pylist(), part["id"].to_pylist(), _unpacked(part["text"]),
                    part["places"].to_pylist()):
                if automaton is None or number != shard:
                    shard, automaton = number, PhraseAutomaton(window, anchor)
                if not is_document:
                    automaton.add(key, text, places)
                    continue
                if automaton.automaton is None:
                    automaton.compile()
                words = text.split()
                covered = automaton.covered(key, words) if key is not None else np.zeros(len(words), bool)
                turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                out["id"].append(key)
                out["n_words"].append(len(words))
                out["n_removed"].append(int(covered.sum()))
                out["removed"].append([{"start": a, "stop": b} for a, b in turns.reshape(-1, 2).tolist()])
                edges = [0, *turns.tolist(), len(words)]
                out["kept"].append(b" ".join([w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]).decode())
            if out:
                yield out

    return run


def remove_repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                             anchor: int = ANCHOR) -> DataFrame:
    """``id``, ``n_words``, ``n_removed``, ``removed`` (spans of words) and ``kept`` (words joined by one blank).

    Words are runs of anything but ASCII white space, unchanged.  A word is removed if a window of ``window`` words that
    covers it also starts in a document with a smaller id; windows are judged on the input.

    * null, empty or blank text: no words, empty ``kept``;
    * null id: nothing is removed, and no other document loses words to it;
    * repeated rows, or several texts under one id: none removes words of the other; one result row for each;
    * empty table: no rows.
    """
    rows = id_and_text(df, id_col, text_col)
    named = rows.filter("id IS NOT NULL")
    # One exchange of the texts, by id, serves both joins with what their documents have to look at.
    by_id = map_arrow(named, _packed, "id bigint, text binary").repartition("id")
    shards = max(1, rows.count() // SHARD_DOCUMENTS)

    def shard(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(shards)).cast("int")

    # Stored, since what is counted and what is looked up are dealt out differently.
    stretches = pin(map_arrow(named, _find(window, anchor), _STRETCH), "all-stretches")
    common = (
        stretches.groupBy("anchor").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
        .select("anchor")
    )
    shared = pin(stretches.join(common.hint("shuffle_hash"), "anchor", "left_semi"), "stretches")
    distinct = pin(
        shared.groupBy("anchor", "stretch").agg(
            F.min("id").alias("id"), F.max("id").alias("last"), F.min_by("start", "id").alias("start"), F.max("n").alias("n")),
        "distinct-stretches",
    )
    mixed = distinct.groupBy("anchor").agg(F.count("*").alias("variants")).filter("variants > 1").select("anchor")
    whole = distinct.join(mixed, "anchor", "left_anti").filter("id < last").select("id", "start", "n", "anchor", "stretch")
    todo = distinct.join(mixed, "anchor", "left_semi").groupBy("id").agg(
        F.collect_list(F.struct("anchor", "stretch", "start", "n", "last")).alias("todo"))
    windows = pin(
        map_arrow(by_id.join(todo.hint("shuffle_hash"), "id"), _open_windows(window, anchor),
                  "anchor bigint, stretch bigint, window bigint, id bigint, last bigint, start int"), "open-windows")
    # One exchange serves the counting of windows and the way back from a window to its stretches.
    by_window = windows.repartition("window")
    single = (
        by_window.groupBy("window")
        .agg(F.min("anchor").alias("anchor"), F.min("id").alias("id"), F.max("last").alias("last"),
             F.min_by("start", "id").alias("start"))
        .filter("id < last").select("id", "start", F.lit(1).alias("n"), "anchor", "window")
    )
    spans = whole.select("id", "start", "n", "anchor").unionByName(single.drop("window")).groupBy("id").agg(
        F.collect_list(F.struct("start", "n", "anchor")).alias("spans"))
    passages = map_arrow(by_id.join(spans.hint("shuffle_hash"), "id"), _passages(window, anchor),
                         "owner bigint, begin int, anchors array<bigint>, places array<int>, passage binary")
    # Each window of a stretch has one owner: as many rows as a stretch has windows, at most.
    owners = whole.select("anchor", "stretch", F.col("id").alias("owner")).unionByName(
        by_window.join(single.select("window", F.col("id").alias("owner")).hint("shuffle_hash"), "window")
        .select("anchor", "stretch", "owner").distinct())
    # However many documents hold a stretch, each shard asks for it once.
    holders = shared.groupBy("anchor", "stretch", shard("id").alias("shard")).agg(F.max("id").alias("top"))
    wanted = owners.join(holders, ["anchor", "stretch"]).filter("owner < top").select("shard", "owner", "anchor").distinct()
    routes = (
        passages.select("owner", "begin", F.explode("anchors").alias("anchor")).distinct().join(wanted, ["owner", "anchor"])
        .select("shard", "owner", "begin").distinct()
    )
    phrases = routes.join(passages.select("owner", "begin", "passage", "places"), ["owner", "begin"]).select(
        "shard", F.lit(False).alias("is_document"), F.col("owner").alias("id"), F.col("passage").alias("text"), "places")
    documents = map_arrow(rows, _packed, "id bigint, text binary").select(shard("id").alias("shard"), F.lit(True).alias("is_document"), "id", "text",
                            F.lit(None).cast("array<int>").alias("places"))
    streamed = phrases.unionByName(documents).repartition("shard").sortWithinPartitions("shard", "is_document")
    return map_arrow(streamed, _remove(window, anchor), (
        "id bigint, n_words bigint, n_removed bigint, removed array<struct<start:bigint,stop:bigint>>, kept string"))
