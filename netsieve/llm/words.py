"""Words of a text, as every operator here counts them.

A word is a maximal run of bytes other than the blank and the five control characters 0x09 to 0x0D.
``bytes.split()`` cuts at exactly these bytes, so it gives the same words as ``WORD`` does on text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def normal_bytes(text: str | None) -> bytes:
    """Lower case, without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, PUNCTUATION)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_count(text: Column) -> Column:
    """UTF-8 length; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def bounded_broadcast(frame: DataFrame, max_rows: int) -> DataFrame:
    """The frame with a broadcast hint if it has at most ``max_rows`` rows, else as it is, for a shuffled join."""
    return F.broadcast(frame) if len(frame.limit(max_rows + 1).select(F.lit(1)).collect()) <= max_rows else frame
