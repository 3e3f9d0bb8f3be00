"""WARC archives of pages, and their capture index by external merge.

Each task writes one archive and its index entries, sorted by (URL key, time): a run.  The runs are cut into ranges of
that order; a task merges the slices of all runs in its range with a loser tree.  Ranges follow each other, so the
captures of the whole collection are in order, a URL's history being consecutive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import as_bytes, map_arrow, slices
from haulmark.session import new_folder, pin
from haulmark.sources.filesystem import make_dir, reading, writing

FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=UTC)
#: Index entries of one merge range, and the most ranges (and so boundaries held by the driver).
ROWS_PER_RANGE, MAX_RANGES = 20_000, 8_192
#: Entries of a run sent as one row.
_ENTRIES_PER_ROW = 1_000
_READ = 1 << 20

# Fixed values of the format.
_VERSION = "WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_ID = "urn:page:"

ENTRY = "url_key string, captured bigint, page_id bigint, file string, start bigint, length bigint"
RECORD = ("file string, start bigint, page_id bigint, url string, captured bigint, payload_bytes bigint, "
          "payload_digest string, record_type string, refers_to bigint, payload binary")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels in reverse, then port, path and query, lower case; scheme and fragment do not count."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").removeprefix("www."), f":{parts.port}" if parts.port else ""
    except ValueError:
        return (url or "").lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}".lower()


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<{_RECORD_ID}{'none' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    value = record_id.strip("<>").removeprefix(_RECORD_ID)
    return None if value == "none" else int(value)


def record(page_id: int | None, url: str | None, captured: int, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; a revisit holds the HTTP header only, with the full payload's length."""
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = answer if refers_to is not None else answer + payload
    lines = [
        _VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {datetime.fromtimestamp(captured, UTC):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # Everything a header line cannot hold is escaped, and the escape sign with it.
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {_REVISIT_PROFILE}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


_URL_SAFE = "".join(chr(c) for c in range(33, 127) if c not in b'%"<>\\^`{|}')


def _unescape(url: str) -> str:
    return re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), url.encode()).decode()


def members(stream: io.RawIOBase) -> Iterator[tuple[int, bytes]]:
    """Start and contents of each gzip member of an archive, read in blocks."""
    at, start, inflate, content, data = 0, 0, zlib.decompressobj(31), [], stream.read(_READ)
    while data:
        content.append(inflate.decompress(data))
        if inflate.eof:
            at += len(data) - len(inflate.unused_data)
            yield start, b"".join(content)
            data, start, content, inflate = inflate.unused_data or stream.read(_READ), at, [], zlib.decompressobj(31)
        else:
            at += len(data)
            data = stream.read(_READ)
    if content:
        raise ValueError("the archive ends inside a record")


def parse(member: bytes) -> dict:
    """The fields of one record; ``payload`` is null for a revisit, whose digest and length are those of its headers."""
    head, _, block = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    answer, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    captured = int(datetime.fromisoformat(fields["WARC-Date"]).timestamp())
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]), "captured": captured,
        "url": _unescape(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", answer)[1]) if revisit else len(payload),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else _digest(payload),
        "record_type": fields["WARC-Type"],
        "refers_to": _page_of(fields["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def _write_archive(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        # A task that runs again writes another file; only files named in the stored index count.
        path, entries, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", [], 0
        with writing(path) as out:
            for batch in batches:
                for part in slices(batch, "payload"):
                    columns = (part[c].to_pylist() for c in ("page_id", "url", "captured", "refers_to"))
                    for payload, page_id, url, captured, refers_to in zip(as_bytes(part["payload"]), *columns):
                        data = record(page_id, url, captured, payload, refers_to)
                        out.write(data)
                        entries.append((url_key(url), captured, page_id, path, at, len(data)))
                        at += len(data)
        entries.sort(key=_order)
        for i in range(0, len(entries), _ENTRIES_PER_ROW):
            yield dict(zip(("url_key", "captured", "page_id", "file", "start", "length"), zip(*entries[i:i + _ENTRIES_PER_ROW])))

    return run


def _order(entry: tuple) -> tuple:
    """Key of the index order: URL key, time, then file and place, which are unique."""
    return entry[0], entry[1], entry[3], entry[4]


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0) -> DataFrame:
    """Write every page as a record and give the index entries (``ENTRY``), one sorted run per archive.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id becomes a response and the
    others revisits of it.  The payload is the HTML in UTF-8.  Pages are captured one second apart, in order of id.

    * null HTML: empty payload; null URL: no target URI, an empty host in its key;
    * null id: a response that nobody refers to, captured first;
    * repeated rows: each gets a record, of one type;
    * empty table: no entries.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "archives")
    make_dir(folder)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    named = rows.filter("page_id IS NOT NULL").select("page_id", F.sha1("payload").alias("sha1"), F.length("payload").alias("bytes"))
    named = named.filter(F.col("bytes") >= min_bytes).select("page_id", "sha1")
    holders = named.groupBy("sha1").agg(F.max("page_id").alias("holder"), F.min("page_id").alias("least")).filter("least < holder")
    revisits = (
        named.join(holders, "sha1").filter("page_id < holder")
        .select(F.col("page_id").alias("_page"), F.unhex("sha1").alias("_sha1"), F.col("holder").alias("refers_to")).distinct()
    )
    # A page is found by its id and payload, since an id may come twice.
    planned = rows.join(
        revisits.hint("shuffle_hash"),
        (F.col("page_id") == F.col("_page")) & (F.unhex(F.sha1("payload")) == F.col("_sha1")), "left",
    ).select("page_id", "url", "payload", "refers_to", (
        F.lit(int(FIRST_CAPTURE.timestamp())) + F.coalesce(F.greatest("page_id", F.lit(0)), F.lit(0)) % 3_000_000_000
    ).alias("captured"))
    return pin(map_arrow(planned, _write_archive(folder), ENTRY), "index-runs")


def read_archives(index: DataFrame) -> DataFrame:
    """All records (``RECORD``) of the archives that an index names; each archive is read by one task, as a stream."""
    # A fixed number of tasks: to adaptive execution a few paths are one partition, whatever the archives hold.
    tasks = 4 * index.sparkSession.sparkContext.defaultParallelism
    files = index.select("file").distinct().repartition(tasks, "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for path in batch["file"].to_pylist():
                with reading(path) as stream:
                    found, size = [], 0
                    for start, member in members(stream):
                        found.append({"file": path, "start": start} | parse(member))
                        size += len(member)
                        if size >= _READ:
                            yield {c: [f[c] for f in found] for c in found[0]}
                            found, size = [], 0
                    if found:
                        yield {c: [f[c] for f in found] for c in found[0]}

    return map_arrow(files, run, RECORD)


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, so a step replays one path to the root."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        self.losers = [-1] * len(runs)
        self.winner = -1
        for leaf in range(len(runs)):
            self._replay(leaf, building=True)

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None
        return _order(self.heads[a]) < _order(self.heads[b])

    def _replay(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node:
            if self.losers[node] < 0 and building:
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.winner = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and (head := self.heads[self.winner]) is not None:
            yield head
            self.heads[self.winner] = next(self.runs[self.winner], None)
            self._replay(self.winner)


def capture_index(runs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The entries of all runs in one order: ``ENTRY`` with ``part`` (ascending ranges) and ``place`` (within the range).

    Ordered by URL key, time and place in the archives.  A URL with very many captures spans several ranges.
    """
    total = runs.count()
    ranges = max(1, min(MAX_RANGES, total // rows_per_range))
    key = F.struct("url_key", "captured", "file", "start")
    sample = [] if ranges == 1 else sorted(
        tuple(r[0]) for r in runs.sample(fraction=min(1.0, 32 * ranges / total), seed=5).select(key).collect())
    cuts = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []

    def slice_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Stretches of a stored run, each within one range."""
        for batch in batches:
            entries = list(zip(*(batch[c].to_pylist() for c in ("url_key", "captured", "page_id", "file", "start", "length"))))
            begin = 0
            for i in range(1, len(entries) + 1):
                if (i == len(entries) or entries[i][3] != entries[begin][3]
                        or bisect_right(cuts, _order(entries[i])) != bisect_right(cuts, _order(entries[begin]))):
                    columns = list(zip(*entries[begin:i]))
                    yield {"part": [bisect_right(cuts, _order(entries[begin]))], "run": [columns[3][0]],
                           "url_keys": [columns[0]], "times": [columns[1]], "pages": [columns[2]],
                           "starts": [columns[4]], "lengths": [columns[5]]}
                    begin = i

    def merge(table: pa.Table) -> pa.Table:
        by_run: dict[str, list[tuple]] = {}
        for row in table.to_pylist():
            file = row["run"]
            by_run.setdefault(file, []).append(list(zip(
                row["url_keys"], row["times"], row["pages"], [file] * len(row["starts"]), row["starts"], row["lengths"])))
        ordered = [iter([e for piece in sorted(pieces, key=lambda p: _order(p[0])) for e in piece]) for pieces in by_run.values()]
        columns = list(zip(*LoserTree(ordered)))
        return pa.table({
            "url_key": pa.array(columns[0], pa.string()), "captured": pa.array(columns[1], pa.int64()),
            "page_id": pa.array(columns[2], pa.int64()), "file": pa.array(columns[3], pa.string()),
            "start": pa.array(columns[4], pa.int64()), "length": pa.array(columns[5], pa.int64()),
            "part": pa.array([table["part"][0].as_py()] * len(columns[0]), pa.int32()),
            "place": pa.array(range(len(columns[0])), pa.int64()),
        })

    stretches = map_arrow(runs, slice_runs, (
        "part int, run string, url_keys array<string>, times array<bigint>, pages array<bigint>, starts array<bigint>, "
        "lengths array<bigint>"))
    return stretches.groupBy("part").applyInArrow(merge, ENTRY + ", part int, place bigint")
