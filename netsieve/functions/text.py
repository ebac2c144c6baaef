"""Text and number coercion as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that counts as white space at the edge of a text value.
WHITESPACE = "".join(
    chr(code)
    for code in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"


def once(value: Column) -> Column:
    """Evaluate in the projection that defines it. A later filter on a derived column would otherwise be
    pushed below that projection together with a copy of the whole expression; the optimizer moves no
    filter past an expression that depends on the partition."""
    return F.when(F.spark_partition_id() >= 0, value)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def as_text(value: Column) -> Column:
    """Null becomes the empty text; edges are stripped."""
    return strip(F.coalesce(value.cast("string"), F.lit("")))


def parse_number(value: Column, numeric: bool = False) -> Column:
    """Double, or null where the text is not a plain decimal number.

    The shape is checked first because a Spark cast also accepts Java suffixes such as ``1d``.
    """
    if numeric:
        number = value.cast("double")
        return F.when(~F.isnan(number), number)
    text = strip(value.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def as_number(value: Column, numeric: bool = False) -> Column:
    return F.coalesce(parse_number(value, numeric), F.lit(0.0))


def as_port(value: Column, numeric: bool = False) -> Column:
    clipped = F.least(F.greatest(as_number(value, numeric), F.lit(0.0)), F.lit(65535.0))
    return F.bround(clipped).cast("int")


def clean_protocol(value: Column) -> Column:
    name = F.upper(as_text(value))
    return F.when(name.isin("-", "0"), F.lit("")).otherwise(name)


def clean_method(value: Column) -> Column:
    return F.upper(as_text(value))


def url_decode(text: Column) -> Column:
    """Form decoding: ``+`` is a space, stray ``%`` stays, bad UTF-8 becomes U+FFFD."""
    repaired = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    encoded = F.contains(text, F.lit("%")) | F.contains(text, F.lit("+"))
    return F.when(encoded, F.coalesce(F.try_url_decode(repaired), text)).otherwise(text)


def request_text(uri: Column) -> Column:
    """The URI as the detectors see it: stripped, then decoded."""
    return url_decode(as_text(uri))


def payload_text(payload: Column) -> Column:
    """A raw web payload: decoded, then stripped."""
    return strip(url_decode(F.coalesce(payload.cast("string"), F.lit(""))))


def truncate(text: Column, limit: int) -> Column:
    clean = as_text(text)
    short = F.concat(F.substring(clean, 1, limit - 3), F.lit("..."))
    return F.when(F.length(clean) > limit, short).otherwise(clean)


def html_escape(text: Column) -> Column:
    escaped = text
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
    return escaped
