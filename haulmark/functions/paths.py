"""Paths and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URI scheme -> kind of file system ('' = a path without scheme).
FS_TYPES = {
    "HDFS": ["", "hdfs", "webhdfs"],
    "S3": ["s3", "s3n", "s3a"],
    "LOCAL": ["file"],
}

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)"
_SCHEME_AND_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fs_type(path: Column | str) -> Column:
    """``HDFS``, ``S3``, ``LOCAL`` or ``UNKNOWN``, from the scheme; null is ``UNKNOWN``."""
    scheme = F.lower(F.regexp_extract(_col(path), _SCHEME, 1))
    kind = F.lit("UNKNOWN")
    for name, schemes in FS_TYPES.items():
        kind = F.when(scheme.isin(schemes), name).otherwise(kind)
    return kind


def split_uri(path: Column | str) -> Column:
    """Struct ``(bucket, key)``; ``bucket`` is null for a path without authority."""
    path = _col(path)
    bucket = F.regexp_extract(path, _AUTHORITY, 1)
    key = F.regexp_replace(F.regexp_replace(path, _SCHEME_AND_AUTHORITY, ""), "^/", "")
    return F.struct(F.when(bucket != "", bucket).alias("bucket"), key.alias("key"))


def clean_path(path: Column | str) -> Column:
    """Path part of a URI with single slashes and no slash at the end (the root becomes ``''``)."""
    bare = F.regexp_replace(_col(path), _SCHEME_AND_AUTHORITY, "")
    return F.regexp_replace(F.regexp_replace(bare, "/+", "/"), "/$", "")


def relative_path(path: Column | str, root: Column | str) -> Column:
    """``path`` below ``root`` component by component; ``.`` if equal, null if not below it."""
    path = clean_path(path)
    root = clean_path(F.lit(root) if isinstance(root, str) else root)
    return F.when(path == root, ".").when(
        path.startswith(F.concat(root, F.lit("/"))), F.substring(path, F.length(root) + 2, F.length(path))
    )


def is_ancestor(x: Column | str, y: Column | str) -> Column:
    """``y`` is ``x`` or lies below it."""
    x, y = _col(x), _col(y)
    return (y == x) | y.startswith(F.concat(x, F.lit("/")))


def parent(path: Column | str) -> Column:
    """Enclosing directory, ``''`` for a top-level name; a slash at the end does not count."""
    return F.regexp_extract(_col(path), "^(.*)/[^/]+/?$", 1)


def ancestors(path: Column | str) -> Column:
    """All strict ancestors of a relative path, topmost first."""
    names = F.split(F.regexp_replace(_col(path), "/$", ""), "/")
    depth = F.size(names)
    return F.when(
        depth > 1,
        F.transform(F.sequence(F.lit(1), depth - 1), lambda n: F.array_join(F.slice(names, 1, n), "/")),
    ).otherwise(F.array().cast("array<string>"))


def suffix(name: Column | str) -> Column:
    """Text after the last dot, dots at the very end not counted; ``''`` if there is none."""
    return F.coalesce(F.regexp_extract(_col(name), r"\.([^.]+)\.*$", 1), F.lit(""))


def replace_suffix(name: Column | str, new: Column | str) -> Column:
    """Cut at the last dot and append ``new``; a name without suffix just gets ``new`` appended."""
    name = _col(name)
    new = F.lit(new) if isinstance(new, str) else new
    stem = F.when(suffix(name) == "", name).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))
    return F.concat(stem, new)


def format_entry(base_dir: Column | str, entry_name: Column | str, is_file: Column | str,
                 file_size: Column | str) -> Column:
    """``base | name | file | size``, as used in reports."""
    kind = F.when(_col(is_file), "file").otherwise("dir")
    return F.concat_ws(" | ", _col(base_dir), _col(entry_name), kind, _col(file_size).cast("string"))


# Names of plan files and of interim part files.
PART_FORMATS = {"filegroup": "filegroup-%03d", "multipart": "multipart-down-%04d"}


def part_name(kind: str, number: Column | str) -> Column:
    """File name of work group or interim part ``number``."""
    return F.format_string(PART_FORMATS[kind], _col(number))


def join_path(base: Column | str, name: Column | str) -> Column:
    """``base/name`` with exactly one slash in between."""
    return F.concat(F.rtrim(_col(base), F.lit("/")), F.lit("/"), _col(name))
