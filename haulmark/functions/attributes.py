"""The set of file attributes a sync keeps equal."""

from __future__ import annotations

# Option letter -> attribute.
ATTRIBUTES = {
    "b": "BLOCK_SIZE",
    "r": "REPLICATION",
    "u": "USER",
    "g": "GROUP",
    "p": "PERMISSION",
}


def parse_attrs(letters: str | None) -> frozenset[str]:
    """``"ug"`` -> USER and GROUP; nothing means all; repeated or unknown letters are errors."""
    if not letters:
        return frozenset(ATTRIBUTES.values())
    unknown = sorted(set(letters) - set(ATTRIBUTES))
    if unknown:
        raise ValueError(f"unknown attribute letters {unknown} in {letters!r}")
    repeated = sorted(c for c in set(letters) if letters.count(c) > 1)
    if repeated:
        raise ValueError(f"repeated attribute letters {repeated} in {letters!r}")
    return frozenset(ATTRIBUTES[c] for c in letters)
