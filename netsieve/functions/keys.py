"""Keys under which traffic is counted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _or_else(value: Column, fallback: Column) -> Column:
    return F.when(value != "", value).otherwise(fallback)


def source_key(record: dict[str, Column]) -> Column:
    protocol = _or_else(record["protocol"], F.lit("UNKNOWN"))
    return _or_else(record["src_ip"], F.concat(F.lit("NO_SRC::"), protocol))


def destination_key(record: dict[str, Column]) -> Column:
    protocol = _or_else(record["protocol"], F.lit("UNKNOWN"))
    port = record["dst_port"].cast("string")
    return _or_else(record["dst_ip"], F.concat(F.lit("NO_DST::"), protocol, F.lit("::"), port))


def endpoint_key(record: dict[str, Column]) -> Column:
    host = _or_else(record["dst_ip"], F.lit("NO_ENDPOINT"))
    return _or_else(record["text"], F.concat(host, F.lit("::"), record["dst_port"].cast("string")))


def traffic_keys(record: dict[str, Column]) -> dict[str, Column]:
    source = source_key(record)
    destination = destination_key(record)
    endpoint = endpoint_key(record)
    return {
        "src": source,
        "dst": destination,
        "src_dst": F.concat(source, F.lit("->"), destination),
        "endpoint": endpoint,
        "request": F.concat(source, F.lit("|"), endpoint),
    }


def key_digest(key: Column) -> Column:
    """16 bytes that stand for a key of any length in joins and stored tables; null for null."""
    return F.unhex(F.md5(key.cast("binary")))
