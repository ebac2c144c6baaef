"""Clean views of one traffic record, as named Column expressions.

A view is a mapping field -> Column plus ``text``, the decoded URI. Feature and key functions take
a view, so the same code serves the record itself and its web-payload view on the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.reuse import built_once

TEXT = "_text"
WEB_URI = "_web_uri"
WEB_TEXT = "_web_text"


def _clean_float(name: str) -> Column:
    value = F.col(name).cast("float")
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0).cast("float")).otherwise(value)


def _clean_port(name: str) -> Column:
    """Event documents may hold any whole number; what is scored lies within the range of ports."""
    number = F.coalesce(F.col(name).cast("long"), F.lit(0))
    return F.least(F.greatest(number, F.lit(0)), F.lit(65535)).cast("int")


@built_once
def primary_view() -> dict[str, Column]:
    """The record in the unified columns of the row; needs :func:`with_text`."""
    return {
        "src_ip": text.as_text(F.col("src_ip")),
        "dst_ip": text.as_text(F.col("dst_ip")),
        "src_port": _clean_port("src_port"),
        "dst_port": _clean_port("dst_port"),
        "protocol": text.clean_protocol(F.col("protocol")),
        "bytes": _clean_float("bytes"),
        "packets": _clean_float("packets"),
        "duration": _clean_float("duration"),
        "http_method": text.clean_method(F.col("http_method")),
        "text": F.col(TEXT),
    }


def with_text(frame: DataFrame) -> DataFrame:
    """Decode the URI once; everything downstream reads the decoded column.

    ``explode`` of one value is a fence, see ``events``: the keys derived from the text stay short for
    the planner.
    """
    return frame.withColumn(TEXT, F.explode(F.array(text.request_text(F.col("uri")))))


@built_once
def web_view() -> dict[str, Column]:
    """The URI of the row alone, seen as a raw web payload; needs :func:`with_web_text`."""
    zero = F.lit(0.0).cast("float")
    return {
        "src_ip": F.lit(""),
        "dst_ip": F.lit(""),
        "src_port": F.lit(0),
        "dst_port": F.lit(0),
        "protocol": F.lit("HTTP"),
        "bytes": F.length(F.col(WEB_URI)).cast("float"),
        "packets": F.lit(1.0).cast("float"),
        "duration": zero,
        "http_method": F.lit("GET"),
        "text": F.col(WEB_TEXT),
    }


def with_web_text(frame: DataFrame, uri: str, wanted: Column) -> DataFrame:
    """The payload text of rows that need a web view, empty for the others."""
    payload = F.when(wanted, text.payload_text(text.as_text(F.col(uri)))).otherwise(F.lit(""))
    frame = frame.withColumn(WEB_URI, F.explode(F.array(payload)))
    return frame.withColumn(WEB_TEXT, F.explode(F.array(text.request_text(F.col(WEB_URI)))))


def code_cut(frame: DataFrame, text: str = TEXT) -> DataFrame:
    """End the generated code here; the column keeps its value.

    Spark writes a chain of projections and broadcast joins as one method, and the JVM runs methods above 8,000 bytes
    uncompiled, at several times the cost. A projection with a higher-order function stays outside that chain.
    """
    return frame.withColumn(text, F.transform(F.array(F.col(text)), lambda value: value)[0])


TEXT_OF = {"primary": TEXT, "web": WEB_TEXT}
VIEWS = {"primary": primary_view, "web": web_view}
