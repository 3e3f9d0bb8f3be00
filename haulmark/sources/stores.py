"""Object stores as the jobs here see them: keys in order, pages of them, objects with what was promised about them."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import time
import uuid
from base64 import b64encode
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import NamedTuple, Protocol

import pyarrow as pa

from haulmark.sources.filesystem import blocks, local_path

TRIES = 4
_FIRST_WAIT_S = 0.1

#: Bytes of names that a process remembers of the directories it reads pages of.
NAMES_KEPT = 64 << 20
#: A directory that changed less than so many seconds ago may change again without its time of change telling.
_SETTLED_S = 2.0


class Stored(NamedTuple):
    """One key of a listing."""

    key: str
    size: int
    mtime: float


class Promise(NamedTuple):
    """What a store knows about one object; ``md5`` (base64) is its own digest, if it keeps one."""

    size: int
    md5: str | None
    user_metadata: dict[str, str]


class Store(Protocol):
    """What a client of a store has to offer.  It travels to tasks by pickling.

    Keys are ordered by code points.  ``OSError`` is trouble that may pass; ``FileNotFoundError`` is not.
    """

    def page(self, prefix: str, after: str, limit: int) -> list[Stored]:
        """The first ``limit`` keys that start with ``prefix`` and come after ``after``, in order; fewer only at the end."""

    def head(self, key: str) -> Promise | None:
        """What is known about an object; None if nothing is."""

    def get(self, key: str) -> Iterator[bytes]:
        """Contents in pieces."""

    def put(self, key: str, content: Iterable[bytes], user_metadata: dict[str, str]) -> None:
        """Store an object, which appears whole or, if ``content`` raises, not at all."""


def retried[T](call: Callable[[], T], tries: int = TRIES, wait: float = _FIRST_WAIT_S) -> T:
    """Call until it works, waiting twice as long each time; the last ``OSError`` is raised."""
    for attempt in range(1, tries + 1):
        try:
            return call()
        except FileNotFoundError:
            raise
        except OSError:
            if attempt == tries:
                raise
            time.sleep(wait * 2 ** (attempt - 1))
    raise ValueError(f"tries: {tries}")


def between(low: str, high: str) -> str | None:
    """A short string after ``low`` and before ``high``, about halfway for keys of plain characters; None if none is found."""
    same = 0
    while same < len(low) and same < len(high) and low[same] == high[same]:
        same += 1
    if same == len(high):
        return None
    first = ord(low[same]) if same < len(low) else 0
    if ord(high[same]) - first > 1:
        return high[:same] + _character(first, ord(high[same]))
    if same == len(low):
        return None
    # Neighbours: stay with ``low`` and go up in the characters that follow.
    for at in range(same + 1, len(low) + 1):
        first = ord(low[at]) if at < len(low) else 0
        top = 0x80 if first < 0x7E else 0x110000
        if top - first > 1:
            return low[:at] + _character(first, top)
    return None


def _character(low: int, high: int) -> str:
    middle = (low + high) // 2
    # Half of a pair is no character; the one before the pairs still lies above ``low`` unless that is a half too.
    return chr(0xD7FF if 0xD800 <= middle <= 0xDFFF and low < 0xD7FF else 0xE000 if 0xD800 <= middle <= 0xDFFF else middle)


class _KnownDirectories:
    """Names in directories, sorted and packed, so that the pages of a directory do not each read it whole.

    Names count as long as the directory has not changed, which is looked up each time.  Those used last stay, up to
    ``NAMES_KEPT`` bytes in all; a directory that is larger by itself is not kept.
    """

    def __init__(self) -> None:
        self._kept: OrderedDict[str, tuple[tuple[int, ...], pa.Array | None]] = OrderedDict()

    def names(self, path: str) -> pa.Array | None:
        """Names as UTF-8 in order, those of directories with a ``/``; None if they are not kept."""
        found = os.stat(path)
        version = found.st_ino, found.st_mtime_ns, found.st_ctime_ns
        known = self._kept.pop(path, None)
        if known is None or known[0] != version:
            if time.time() - max(found.st_mtime, found.st_ctime) < _SETTLED_S:
                return None
            known = version, self._read(path)
        self._kept[path] = known
        while sum(names.nbytes for _, names in self._kept.values() if names is not None) > NAMES_KEPT:
            self._kept.popitem(last=False)
        return known[1]

    @staticmethod
    def _read(path: str) -> pa.Array | None:
        names, size = [], 0
        with os.scandir(path) as entries:
            for entry in entries:
                names.append(_packed(entry.name + ("/" if entry.is_dir(follow_symlinks=False) else "")))
                # And four bytes for its place.
                size += len(names[-1]) + 4
                if size > NAMES_KEPT:
                    return None
        names.sort()
        return pa.array(names, pa.binary())


def _packed(name: str) -> bytes:
    """UTF-8, which sorts as the code points do; names need not be valid."""
    return name.encode("utf-8", "surrogatepass")


_known = _KnownDirectories()


class FolderStore:
    """A store in a folder that all executors reach: objects are files below ``root``, and what was promised about them
    is kept in files of the same names below ``<root>.promised``.

    A key cannot be an object and at the same time the beginning of another up to a ``/``.  Keys ending in ``/`` are empty
    directories.  A process remembers the names in directories that do not change between its pages, up to ``NAMES_KEPT``
    bytes; of others a page reads the directories on its way and keeps no more than a page of each in memory.
    """

    def __init__(self, root: str):
        local = local_path(root)
        if local is None:
            raise ValueError(f"{root} is not a folder on a file system that is mounted here")
        self.root = "/" + local.strip("/")
        self.promised = self.root + ".promised"

    def page(self, prefix: str, after: str, limit: int) -> list[Stored]:
        return list(islice(self._walk("", prefix, after, limit), limit))

    def _walk(self, directory: str, prefix: str, after: str, limit: int) -> Iterator[Stored]:
        """Keys of one directory in order."""
        for name, is_dir in self._entries(directory, prefix, after, limit):
            path = f"{self.root}/{name}"
            if not is_dir:
                found = os.stat(path)
                yield Stored(name, found.st_size, found.st_mtime)
                continue
            empty = True
            for below in self._walk(name, prefix, after, limit):
                empty = False
                yield below
            if empty and name > after and name.startswith(prefix) and not any(os.scandir(path)):
                yield Stored(name, 0, os.stat(path).st_mtime)

    def _entries(self, directory: str, prefix: str, after: str, limit: int) -> Iterator[tuple[str, bool]]:
        """Names in one directory, in order, that are keys asked for or may hold some; a directory sorts as its name with
        the ``/`` that follows it."""
        def asked(name: str, is_dir: bool) -> bool:
            # A directory counts if keys below it may still come.
            late = name > after or (is_dir and after.startswith(name))
            return late and (name.startswith(prefix) or (is_dir and prefix.startswith(name)))

        known = _known.names(f"{self.root}/{directory}")
        if known is not None:
            def below(key: str) -> bytes:
                return _packed(key[len(directory):]) if key.startswith(directory) else b""

            beginning, plain = below(prefix), pa.BinaryScalar.as_py
            # The directory that holds ``after`` or ``prefix`` is the last before its place.
            first = max(bisect_right(known, below(after), key=plain), bisect_left(known, beginning, key=plain)) - 1
            for at in range(max(0, first), len(known)):
                packed = known[at].as_py()
                if packed > beginning and not packed.startswith(beginning):
                    return
                name = directory + packed.decode("utf-8", "surrogatepass")
                if asked(name, name.endswith("/")):
                    yield name, name.endswith("/")
            return

        def names(last: str) -> Iterator[tuple[str, bool]]:
            with os.scandir(f"{self.root}/{directory}") as entries:
                for entry in entries:
                    is_dir = entry.is_dir(follow_symlinks=False)
                    name = directory + entry.name + ("/" if is_dir else "")
                    if name > last and asked(name, is_dir):
                        yield name, is_dir

        last = ""
        while chunk := heapq.nsmallest(limit, names(last)):
            yield from chunk
            last = chunk[-1][0]

    def head(self, key: str) -> Promise | None:
        try:
            with open(f"{self.promised}/{key}", encoding="utf-8") as stream:
                return Promise(**json.load(stream))
        except FileNotFoundError:
            return None

    def get(self, key: str) -> Iterator[bytes]:
        with open(f"{self.root}/{key}", "rb") as stream:
            yield from blocks(stream)

    def put(self, key: str, content: Iterable[bytes], user_metadata: dict[str, str]) -> None:
        digest, size = hashlib.md5(usedforsecurity=False), 0

        def counted() -> Iterator[bytes]:
            nonlocal size
            for piece in content:
                digest.update(piece)
                size += len(piece)
                yield piece

        ready = self._written(counted())
        try:
            promise = Promise(size, b64encode(digest.digest()).decode(), user_metadata)
            # Contents first: an object is not promised before it is there.
            self._placed(ready, f"{self.root}/{key}")
            self.promise(key, promise)
        except BaseException:
            _dropped(ready)
            raise

    def promise(self, key: str, promise: Promise) -> None:
        """Replace what is known about an object."""
        self._placed(self._written([json.dumps(promise._asdict()).encode()]), f"{self.promised}/{key}")

    def _written(self, content: Iterable[bytes]) -> str:
        os.makedirs(self.promised + ".writing", exist_ok=True)
        path = f"{self.promised}.writing/{uuid.uuid4().hex}"
        try:
            with open(path, "wb") as out:
                out.writelines(content)
        except BaseException:
            _dropped(path)
            raise
        return path

    @staticmethod
    def _placed(ready: str, path: str) -> None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        os.replace(ready, path)


def _dropped(path: str) -> None:
    if os.path.exists(path):
        os.unlink(path)
