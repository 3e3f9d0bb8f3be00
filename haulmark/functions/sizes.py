"""Byte counts as text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KIB, MIB, GIB = 1024, 1024**2, 1024**3

# Unit letter of a size parameter -> power of 1024.
UNIT_POWERS = {"": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5, "e": 6}

_SIZE = r"^\s*([+-]?[0-9]+)([kKmMgGtTpPeE]?)\s*$"


def parse_size(text: Column | str) -> Column:
    """``1230k`` -> 1259520; null for anything malformed, not positive or beyond 64 bits."""
    text = F.col(text) if isinstance(text, str) else text
    unit = F.lower(F.regexp_extract(text, _SIZE, 2))
    factor = F.lit(None).cast("bigint")
    for letter, power in UNIT_POWERS.items():
        factor = F.when(unit == letter, F.lit(1024**power).cast("bigint")).otherwise(factor)
    number = F.regexp_extract(text, _SIZE, 1).try_cast("bigint")
    size = F.try_multiply(number, factor)
    return F.when(size > 0, size)


def human_bytes(count: Column | str) -> Column:
    """``1536 bytes (1.5k)``."""
    count = F.col(count) if isinstance(count, str) else count
    size = F.abs(count)

    def scaled(unit: int, letter: str) -> Column:
        value = count.cast("double") / F.lit(float(unit))
        return F.concat(F.call_function("format_number", value, F.lit("0.0")), F.lit(letter))

    short = (
        F.when(size < KIB, scaled(1, ""))
        .when(size < MIB, scaled(KIB, "k"))
        .when(size < GIB, scaled(MIB, "m"))
        .otherwise(scaled(GIB, "g"))
    )
    return F.concat(count.cast("string"), F.lit(" bytes ("), short, F.lit(")"))
