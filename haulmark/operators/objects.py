"""Files into and out of object stores, with a digest and a length that travel along and are enforced on reading."""

from __future__ import annotations

import base64
import hashlib
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.operators.diff import verify_objects
from haulmark.session import pin
from haulmark.sources import filesystem as fs
from haulmark.sources.stores import TRIES, Promise, Store, retried

#: User metadata under which an upload promises what it stored.
MD5_KEY, LENGTH_KEY = "contentmd5", "contentlength"

_UPLOADED = "src_file string, key string, status string, attempts int, file_size bigint, md5 string, error string"
_DOWNLOADED = "key string, dest_file string, status string, attempts int, file_size bigint, md5 string, error string"
_PROMISED = "entry_name string, content_length bigint, content_md5 string, user_metadata map<string,string>"
_READ = f"{_PROMISED}, md5 string, bytes_read bigint"


class _Refused(Exception):
    """An outcome that has a name of its own."""


def _names(ddl: str) -> list[str]:
    return [field.split(" ")[0] for field in ddl.split(", ")]


class _Digested:
    """Passes pieces on and keeps their digest and length."""

    def __init__(self, pieces: Iterator[bytes]):
        self._pieces, self._digest, self.size = pieces, hashlib.md5(usedforsecurity=False), 0

    def __iter__(self) -> Iterator[bytes]:
        for piece in self._pieces:
            self._digest.update(piece)
            self.size += len(piece)
            yield piece

    def md5(self) -> str:
        return base64.b64encode(self._digest.digest()).decode()

    def drain(self) -> _Digested:
        for _ in self:
            pass
        return self


def _file(path: str) -> Iterator[bytes]:
    with fs.reading(path) as stream:
        yield from fs.blocks(stream)


def _tried(calls: Sequence[Callable[[], tuple[int, str]]], tries: int) -> list[tuple[str | None, int, int | None, str | None, str | None]]:
    """``(status, attempts, size, md5, error)`` of the last attempt of each call; None for a success.

    Refusals are tried again.  A call has its next attempt when all others have had theirs, so many that fail wait together.
    """
    found = [(None, tries, None, None, None)] * len(calls)
    waiting = range(len(calls))
    for attempt in range(1, tries + 1):
        again = []
        for i in waiting:
            try:
                size, md5 = calls[i]()
                found[i] = None, attempt, size, md5, None
            except FileNotFoundError as e:
                found[i] = "OPEN_FAILED", attempt, None, None, str(e)
            except _Refused as e:
                found[i] = e.args[0], attempt, None, None, e.args[1]
                again.append(i)
            except (OSError, ValueError) as e:
                found[i] = "FAILED", attempt, None, None, str(e)
                again.append(i)
        waiting = again
        if not waiting:
            break
        if attempt < tries:
            time.sleep(0.05 * 2 ** (attempt - 1))
    return found


def _upload(store: Store, src_file: str, key: str) -> tuple[int, str]:
    before = _Digested(_file(src_file)).drain()
    sent = _Digested(_file(src_file))

    def checked() -> Iterator[bytes]:
        yield from sent
        # Raised inside the upload, so nothing appears under the key.
        if (sent.md5(), sent.size) != (before.md5(), before.size):
            raise _Refused("CHECKSUM_MISMATCH", f"sent {sent.md5()}, the file had {before.md5()}")

    store.put(key, checked(), {MD5_KEY: before.md5(), LENGTH_KEY: str(before.size)})
    return before.size, before.md5()


def _spread(df: DataFrame, key: str, tasks: int | None) -> DataFrame:
    return df.repartition(tasks or 4 * df.sparkSession.sparkContext.defaultParallelism, key)


def upload_files(pairs: DataFrame, store: Store, tries: int = TRIES, tasks: int | None = None) -> DataFrame:
    """Store files (``src_file, key``) with their digest and length as user metadata; one stored result row per pair.

    A file is digested before it is sent and again while it is sent; if the two differ nothing is stored.  ``status``:
    ``UPLOADED``, ``OPEN_FAILED`` (no such file), ``CHECKSUM_MISMATCH`` (it kept changing) or ``FAILED``.  A task may run
    twice: a key is only ever replaced by the whole file.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = list(zip(batch["src_file"], batch["key"]))
            found = _tried([partial(_upload, store, src_file, key) for src_file, key in pairs], tries)
            yield _frame([(*pair, status or "UPLOADED", *rest) for pair, (status, *rest) in zip(pairs, found)], _UPLOADED)

    return pin(_spread(pairs.select("src_file", "key"), "key", tasks).mapInPandas(run, _UPLOADED), "uploads")


def _frame(rows: list[tuple], ddl: str) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_names(ddl))
    whole = [name for name in ("file_size", "content_length", "bytes_read") if name in frame]
    return frame.astype(dict.fromkeys(whole, "Int64"))


def read_objects(listing: DataFrame, store: Store, contents: bool = True, tries: int = TRIES,
                 tasks: int | None = None) -> DataFrame:
    """META of the files of a listing, with ``md5, bytes_read`` of what was really read; objects without META have no row.

    Empty objects and, with ``contents=False``, all others are not read; nor are those whose own metadata are in conflict.
    An object that cannot be read has null there.  Names are keys below ``base_dir``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, calls, read = [], [], []
            for name, key in zip(batch["entry_name"], batch["key"]):
                promise = retried(lambda: store.head(key), tries)
                if promise is None:
                    continue
                if contents and promise.size and not _conflict(promise):
                    read.append(len(rows))
                    calls.append(partial(_read, store, key))
                rows.append((name, promise.size, promise.md5, promise.user_metadata, None, None))
            for i, (_, _, count, md5, _) in zip(read, _tried(calls, tries)):
                rows[i] = *rows[i][:4], md5, count
            yield _frame(rows, _READ)

    key = F.when(F.col("base_dir") == "", F.col("entry_name")).otherwise(F.concat_ws("/", "base_dir", "entry_name"))
    files = listing.filter("is_file").select("entry_name", key.alias("key"))
    return _spread(files, "key", tasks).mapInPandas(run, _READ)


def _read(store: Store, key: str) -> tuple[int, str]:
    found = _Digested(store.get(key)).drain()
    return found.size, found.md5()


def _conflict(promise: Promise) -> bool:
    length = promise.user_metadata.get(LENGTH_KEY, "")
    return length.isdecimal() and int(length) != promise.size


def verify_store(listing: DataFrame, store: Store, verify: bool = True, tries: int = TRIES) -> DataFrame:
    """``verify_objects`` of a real store: every object is read once, in the task that also asks for its metadata."""
    found = pin(read_objects(listing, store, tries=tries), "objects")
    digests = found.filter("bytes_read IS NOT NULL").select("entry_name", "md5", "bytes_read")
    return verify_objects(listing, found.select("entry_name", "content_length", "content_md5", "user_metadata"), digests, verify)


def _download(store: Store, key: str, dest_file: str, verify: bool) -> tuple[int, str]:
    promise = store.head(key)
    if promise is None:
        raise _Refused("NO_METADATA", f"nothing is known about {key}")
    if _conflict(promise):
        raise _Refused("LENGTH_CONFLICT", f"{promise.user_metadata[LENGTH_KEY]} bytes promised, {promise.size} stored")
    expected = promise.user_metadata.get(MD5_KEY, promise.md5)
    if verify and expected is None and promise.size:
        raise _Refused("NO_CHECKSUM", f"no digest was stored with {key}")
    fs.make_dir(dest_file.rpartition("/")[0] or "/")
    temp = f"{dest_file}._tmp_{uuid.uuid4().hex}"
    found = _Digested(store.get(key))
    try:
        with fs.writing(temp) as out:
            for piece in found:
                out.write(piece)
        if found.size != promise.size:
            raise _Refused("SHORT_READ", f"read {found.size} of {promise.size} bytes")
        if verify and promise.size and found.md5() != expected:
            raise _Refused("CHECKSUM_MISMATCH", f"read {found.md5()}, expected {expected}")
        fs.move(temp, dest_file)
    except BaseException:
        fs.remove(temp)
        raise
    return found.size, found.md5()


def download_files(objects: DataFrame, store: Store, verify: bool = True, tries: int = TRIES,
                   tasks: int | None = None) -> DataFrame:
    """Objects (``key, dest_file``) as files; one stored result row per object.

    A file appears whole and checked, or not at all: length and digest must be what was promised (the user's
    ``contentmd5``, else the store's own).  ``status``: ``DOWNLOADED``, ``NO_METADATA``, ``LENGTH_CONFLICT``,
    ``NO_CHECKSUM``, ``SHORT_READ``, ``CHECKSUM_MISMATCH``, ``OPEN_FAILED`` or ``FAILED``.  With ``verify=False`` digests
    are neither needed nor compared; lengths are.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = list(zip(batch["key"], batch["dest_file"]))
            found = _tried([partial(_download, store, key, dest_file, verify) for key, dest_file in pairs], tries)
            yield _frame([(*pair, status or "DOWNLOADED", *rest) for pair, (status, *rest) in zip(pairs, found)], _DOWNLOADED)

    return pin(_spread(objects.select("key", "dest_file"), "key", tasks).mapInPandas(run, _DOWNLOADED), "downloads")
