"""Folds by doc_id and bounded samples, both decided row by row from a hash; names for helper columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n."""
    return F.crc32(key.cast("string").cast("binary")) % n


def drawn(key: Column, wanted: int, there: Column) -> Column:
    """True for about ``wanted`` of ``there`` rows: the expected size of the sample is bounded, the choice repeatable."""
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30)) * there < F.lit(wanted * (1 << 30))


def unused(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
