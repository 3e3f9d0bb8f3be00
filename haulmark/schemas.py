"""Row layouts shared by the operators.

Columns beyond the ones named here are allowed everywhere and carried along where an operator says so.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _B, _I = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType()

#: One entry of a tree.  ``entry_name`` is relative, has no leading ``/``; empty directories end in ``/``.
LISTING = _struct(("base_dir", _S), ("entry_name", _S), ("is_file", _B), ("file_size", _L))

#: Optional attributes a listing may carry (needed by ``attr_drift``).
LISTING_ATTRIBUTES = _struct(
    ("mtime", T.TimestampType()), ("owner", _S), ("grp", _S), ("permission", _S),
    ("replication", _I), ("block_size", _L),
)

#: One unit of work; ``dest_file`` is ``''`` when there is only something to read.
PAIR = _struct(("src_file", _S), ("dest_file", _S), ("is_file", _B), ("file_size", _L))

#: A pair that was given to a work group.
GROUPED_PAIR = T.StructType([*PAIR.fields, T.StructField("group_id", _I, True)])

#: Digest of one file.
DIGEST = _struct(("path", _S), ("md5", _S))

#: What an object store knows about one object; user metadata keys are lower case.
META = _struct(
    ("entry_name", _S), ("content_length", _L), ("content_md5", _S),
    ("user_metadata", T.MapType(_S, _S)),
)

UPLOADS = _struct(
    ("bucket", _S), ("key", _S), ("upload_id", _S), ("initiated", T.TimestampType()), ("storage_class", _S),
)
PARTS = _struct(("upload_id", _S), ("part_number", _I), ("size", _L))

#: Byte range of a file, ``end`` inclusive.
RANGES = _struct(("entry_name", _S), ("part_no", _L), ("begin", _L), ("end", _L))

#: One row per pair handled by ``copy_files``.
RESULT = _struct(
    ("src_file", _S), ("dest_file", _S), ("status", _S), ("attempts", _I),
    ("bytes_expected", _L), ("bytes_copied", _L), ("src_md5", _S), ("elapsed_ms", _L), ("error", _S),
)

#: One transfer of a worker, as logged.
TRANSFERS = _struct(("worker", _L), ("ts", T.TimestampType()), ("bytes", _L))
