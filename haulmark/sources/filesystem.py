"""Opening files inside tasks: the local disk directly, anything else through ``pyarrow.fs``."""

from __future__ import annotations

import grp
import os
import pwd
import shutil
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache
from stat import S_IMODE, S_ISDIR, S_ISLNK
from threading import BoundedSemaphore
from typing import BinaryIO, NamedTuple

BLOCK = 1024 * 1024

#: Replaced files of a process that wait to be freed, at most, and the threads that free them.
_MOST_HELD = 64
_FREEING_THREADS = 4


class Child(NamedTuple):
    name: str
    is_file: bool
    size: int
    mtime: float
    owner: str | None = None
    grp: str | None = None
    permission: str | None = None


@lru_cache(maxsize=4096)
def _user_name(uid: int) -> str:
    try:
        return pwd.getpwuid(uid).pw_name
    except KeyError:
        return str(uid)


@lru_cache(maxsize=4096)
def _group_name(gid: int) -> str:
    try:
        return grp.getgrgid(gid).gr_name
    except KeyError:
        return str(gid)


def _described(found: os.stat_result) -> tuple[str, str, str | None]:
    """Owner, group and permission (four octal digits; a link has none of its own)."""
    permission = None if S_ISLNK(found.st_mode) else f"{S_IMODE(found.st_mode):04o}"
    return _user_name(found.st_uid), _group_name(found.st_gid), permission


def attributes(path: str) -> tuple[str | None, str | None, str | None]:
    """Owner, group and permission of one entry; nulls where the file system is not the local one."""
    local = local_path(path)
    return _described(os.lstat(local)) if local is not None else (None, None, None)


def set_attributes(path: str, owner: str | None, group: str | None, permission: str | None) -> None:
    """Change what is not None.  Names that are none of this machine may be numbers.  Links are not followed."""
    local = local_path(path)
    if local is None:
        raise ValueError(f"attributes of {path} cannot be set")
    if owner is not None or group is not None:
        uid = -1 if owner is None else int(owner) if owner.isdigit() else pwd.getpwnam(owner).pw_uid
        gid = -1 if group is None else int(group) if group.isdigit() else grp.getgrnam(group).gr_gid
        os.chown(local, uid, gid, follow_symlinks=False)
    # After the owner, whose change takes some permissions away.
    if permission is not None:
        if os.path.islink(local):
            raise ValueError(f"{path} is a link and has no permission of its own")
        os.chmod(local, int(permission, 8))


def local_path(path: str) -> str | None:
    """Path on this machine, or None for another file system."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if "://" not in path else None


def _remote(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition("://")
    if scheme in ("s3n", "s3a"):
        scheme = "s3"
    return fs.FileSystem.from_uri(f"{scheme}://{rest}")


def children(path: str) -> Iterator[Child]:
    """Direct children of a directory, as a stream on the local disk."""
    local = local_path(path)
    if local is not None:
        with os.scandir(local) as entries:
            for e in entries:
                # A link counts as a file, with the size of what reading it gives; links are not walked into.
                is_file = not e.is_dir(follow_symlinks=False)
                stat = e.stat(follow_symlinks=e.is_symlink() and os.path.isfile(e.path))
                own = _described(e.stat(follow_symlinks=False))
                yield Child(e.name, is_file, stat.st_size if is_file else 0, stat.st_mtime, *own)
        return
    from pyarrow import fs

    store, inner = _remote(path)
    for info in store.get_file_info(fs.FileSelector(inner)):
        is_file = info.type == fs.FileType.File
        mtime = info.mtime.timestamp() if info.mtime else 0.0
        yield Child(info.base_name, is_file, info.size or 0, mtime)


def stat(path: str) -> tuple[bool, bool, int]:
    """``(exists, is_file, size)``."""
    local = local_path(path)
    if local is not None:
        try:
            found = os.lstat(local)
        except (OSError, ValueError):
            return False, False, 0
        if S_ISLNK(found.st_mode):
            is_file = not os.path.isdir(local)
            return True, is_file, os.path.getsize(local) if is_file else 0
        is_file = not S_ISDIR(found.st_mode)
        return True, is_file, found.st_size if is_file else 0
    from pyarrow import fs

    store, inner = _remote(path)
    info = store.get_file_info(inner)
    return info.type != fs.FileType.NotFound, info.type == fs.FileType.File, info.size or 0


@contextmanager
def reading(path: str) -> Iterator[BinaryIO]:
    """Open for reading; the object has ``read(n)``, which may give less before the end, and ``seek(n)``."""
    local = local_path(path)
    if local is not None:
        # Read in blocks anyway: a buffer would be made for every small file, and be of no use to a large one.
        with open(local, "rb", buffering=0) as stream:
            yield stream
        return
    store, inner = _remote(path)
    with store.open_input_file(inner) as stream:
        yield stream


@contextmanager
def writing(path: str) -> Iterator[BinaryIO]:
    """Open a new file for writing."""
    local = local_path(path)
    if local is not None:
        with open(local, "wb") as stream:
            yield stream
        return
    store, inner = _remote(path)
    # Not by the name: a file called x.gz is written as it is.
    with store.open_output_stream(inner, compression=None) as stream:
        yield stream


def writes_at_offsets(path: str) -> bool:
    """Whether parts of a new file can be written in any order; stores only take a file from its start."""
    return local_path(path) is not None


@contextmanager
def writing_at(path: str, size: int, offset: int) -> Iterator[BinaryIO]:
    """Open a file of ``size`` bytes, made by whoever comes first, for writing from ``offset`` on."""
    local = local_path(path)
    if local is None:
        raise ValueError(f"{path} cannot be written at an offset")
    handle = os.open(local, os.O_RDWR | os.O_CREAT, 0o666)
    with os.fdopen(handle, "r+b") as out:
        os.ftruncate(handle, size)
        out.seek(offset)
        yield out


def make_dir(path: str) -> None:
    """Create a directory and its parents."""
    local = local_path(path)
    if local is not None:
        if not os.path.isdir(local):
            os.makedirs(local, exist_ok=True)
        return
    store, inner = _remote(path)
    store.create_dir(inner, recursive=True)


class _Replaced:
    """Replaced files that are kept until they are freed in the background.  Sent with a task's code it starts anew."""

    def __init__(self) -> None:
        self._pool: ThreadPoolExecutor | None = None
        self._room = BoundedSemaphore(_MOST_HELD)
        self._on_disk: dict[str, bool] = {}

    def __reduce__(self) -> tuple:
        return _Replaced, ()

    def hold(self, local: str) -> int | None:
        """A handle that keeps what is there; None if there is nothing or it is on no disk of this machine.

        Shares from elsewhere, which have no device, move open files aside first: they would not be replaced in one step.
        """
        directory = os.path.dirname(local)
        try:
            if directory not in self._on_disk:
                self._on_disk[directory] = hasattr(os, "O_PATH") and os.major(os.stat(directory or ".").st_dev) != 0
            return os.open(local, os.O_PATH | os.O_NOFOLLOW) if self._on_disk[directory] else None
        except (OSError, ValueError):
            return None

    def free(self, handle: int) -> None:
        """Close the handle in the background, or at once if many wait already."""
        if not self._room.acquire(blocking=False):
            os.close(handle)
            return
        if self._pool is None:
            self._pool = ThreadPoolExecutor(_FREEING_THREADS)
        self._pool.submit(self._close, handle)

    def _close(self, handle: int) -> None:
        try:
            os.close(handle)
        finally:
            self._room.release()


_replaced = _Replaced()


def move(path: str, target: str) -> None:
    """Put a finished file in its place, replacing what was there.

    Blocks of a replaced file are freed with its last reference.  On a disk that is told of each that takes longer than the
    copy of a small file, and it would be under the lock of the directory, one file after the other: so it is put off.
    """
    local = local_path(path)
    if local is not None:
        place = local_path(target)
        handle = _replaced.hold(place)
        try:
            os.replace(local, place)
        finally:
            if handle is not None:
                _replaced.free(handle)
        return
    store, inner = _remote(path)
    store.move(inner, _remote(target)[1])


def remove(path: str) -> None:
    """Delete one file if it is there."""
    local = local_path(path)
    if local is not None:
        if os.path.lexists(local):
            os.unlink(local)
        return
    if stat(path)[0]:
        store, inner = _remote(path)
        store.delete_file(inner)


def remove_tree(path: str) -> None:
    """Delete a file, or a directory with all it holds, if it is there."""
    local = local_path(path)
    if local is not None:
        if os.path.isdir(local) and not os.path.islink(local):
            shutil.rmtree(local)
        else:
            remove(path)
        return
    exists, is_file, _ = stat(path)
    if exists and not is_file:
        store, inner = _remote(path)
        store.delete_dir(inner)
    elif exists:
        remove(path)


def blocks(stream: BinaryIO, begin: int = 0, length: int | None = None) -> Iterator[bytes]:
    """Contents from ``begin`` on, in 1 MiB pieces."""
    if begin:
        stream.seek(begin)
    left = length
    while left is None or left > 0:
        data = stream.read(BLOCK if left is None else min(BLOCK, left))
        if not data:
            return
        if left is not None:
            left -= len(data)
        yield data
