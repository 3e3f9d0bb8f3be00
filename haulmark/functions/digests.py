"""MD5 in the two spellings that object stores and tools use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Base64 MD5 of nothing.
EMPTY_MD5 = "1B2M2Y8AsgTpgAmY7PhCfg=="


def md5_base64(content: Column | str) -> Column:
    """Base64 of the 16 digest bytes (24 characters, no line breaks)."""
    return F.base64(F.unhex(F.md5(content)))


def md5_hex(content: Column | str) -> Column:
    """Lower-case hex digest."""
    return F.md5(content)


def digest_words(md5: Column | str) -> list[Column]:
    """A base64 MD5 as three integers (60, 60 and 8 bits), null if it is null or malformed.

    Equal digests have equal words and the other way round.  Aggregates over integers hash; over strings they sort.
    """
    digits = F.hex(F.try_to_binary(md5, F.lit("base64")))
    return [
        F.when(F.length(digits) == 32, F.conv(F.substring(digits, start, length), 16, 10)).try_cast("bigint")
        for start, length in ((1, 15), (16, 15), (31, 2))
    ]
