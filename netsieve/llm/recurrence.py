"""Helpers to find sequences that recur anywhere in a corpus, without bringing equal things together in one task.

Documents are dealt by a hash into shards of bounded size. A shard names what it holds by 64-bit hashes; the distinct hashes
go, sorted and packed, to buckets by value, where hashes from all shards meet; each bucket answers with one bit for
each hash it got. A hash that a third of all documents share is one entry for each shard. The exchange of the
documents by shard is the same plan wherever it is used, so Spark runs it once.

Every window of ``length`` symbols is given an anchor: the gram of ``gram`` symbols inside it with the lowest hash (the leftmost, if equal).
Equal windows have equal anchors, so only windows whose anchors recur can recur, and anchors are few.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 8 << 20
PIECE = 1 << 17  # so that the arrays of a piece stay in the cache
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
POSITION = np.uint64(0xFFFFFFFF)
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo 2^64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE + 1)
        have = np.ones(size, np.uint64)
        k = 1
        while k < size:
            m = min(k, size - k)
            have[k : k + m] = have[:m] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        if size <= 8 * PIECE:
            _powers[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


class Sums(NamedTuple):
    """Prefix sums of symbols times powers: hashes of any stretch in two look-ups."""

    prefix: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray) -> Sums:
        prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * powers(BASE, len(symbols)), out=prefix[1:])
        return cls(prefix)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k symbols from each position on."""
        n = max(0, len(self.prefix) - k)
        return mixed((self.prefix[k:] - self.prefix[:n]) * powers(INVERSE, n))

    def stretches(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * powers(INVERSE, len(self.prefix))[start] + (end - start).astype(np.uint64) * np.uint64(BASE))


class Runs(NamedTuple):
    """Consecutive windows with the same anchor: hash of the anchor, first window, number of windows; and which document."""

    anchor: np.ndarray
    start: np.ndarray
    count: np.ndarray
    doc: np.ndarray


def runs(sums: Sums, bounds: np.ndarray, length: int, gram: int) -> Runs:
    """Runs of the windows that lie inside one of the documents [bounds[i], bounds[i + 1])."""
    n = len(sums.prefix) - 1
    if n < length:
        none = np.zeros(0, np.int64)
        return Runs(np.zeros(0, np.uint64), none, none, none)
    h = sums.grams(gram)
    low = (h & ~POSITION) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, length - gram + 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        rest = width - span
        low = np.minimum(low[:-rest], low[rest:])
    at = (low[: n - length + 1] & POSITION).astype(np.int64)
    sizes = np.diff(bounds)
    inside = np.zeros(n + 1, np.int32)
    whole = sizes >= length
    np.add.at(inside, bounds[:-1][whole], 1)
    np.add.at(inside, bounds[1:][whole] - length + 1, -1)
    valid = np.cumsum(inside)[: len(at)] > 0
    first = valid.copy()
    first[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    starts = bounds[:-1][whole]
    first[starts] = True
    start = np.flatnonzero(first)
    doc = np.searchsorted(bounds, start, side="right") - 1
    end = np.r_[start[1:], n]
    end = np.minimum(end, bounds[doc + 1] - length + 1)
    return Runs(h[at[start]], start, end - start, doc)


def word_symbols(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of a text in bytes."""
    space = SPACE[data]
    edge = np.diff(np.r_[True, space, True].astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = Sums.of(BYTE_VALUES[data])
    return sums.stretches(start, end), start, end


class Table(NamedTuple):
    """A shard's documents, in an order that does not depend on how the shard was read."""

    ids: np.ndarray
    texts: list[bytes]


def shard_documents(table: pa.Table) -> Table:
    ids = table.column("doc").to_numpy(zero_copy_only=False)
    texts = [b"" if t is None else t for t in table.column("body").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    return Table(ids[order], [texts[i] for i in order])


def pieces(texts: list[bytes], gap: bytes = b" "):
    """(first document, last + 1, bytes, bounds) of consecutive documents of about ``PIECE`` bytes together; a gap follows each."""
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to]) < PIECE):
            size += len(texts[to]) + len(gap)
            to += 1
        bounds = np.zeros(to - at + 1, np.int64)
        np.cumsum([len(t) + len(gap) for t in texts[at:to]], out=bounds[1:])
        yield at, to, np.frombuffer(gap.join(texts[at:to]) + gap, np.uint8), bounds
        at = to


def shard_count(documents: DataFrame, text: str, shard_bytes: int = SHARD_BYTES) -> int:
    total = documents.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0]
    return max(1, math.ceil((total or 0) / shard_bytes))


def by_shard(documents: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """doc (null keys before all others), null_key, body, shard: the only shuffle of texts."""
    body = F.col(f"`{text}`").cast("string")
    number = F.col(f"`{key}`").cast("long")
    rows = documents.select(
        F.coalesce(number, F.lit(-(2**63)).cast("long")).alias("doc"),
        body.cast("binary").alias("body"),
        F.pmod(F.xxhash64(number, body), F.lit(shards)).cast("int").alias("shard"),
    )
    return rows.repartition("shard")


def bucket_count(shards: int, shards_each: int = 8) -> int:
    """Buckets that get as many hashes as ``shards_each`` shards name."""
    return max(24, shards // shards_each)


def buckets_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def packed(shard: int, n_buckets: int, hashes: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """Rows (bucket, shard, hashes, columns) for sorted hashes: one for each bucket that gets any."""
    place = buckets_of(hashes, n_buckets)
    edges = np.flatnonzero(np.r_[True, np.diff(place) != 0, True]) if len(place) else np.zeros(1, np.int64)
    rows = list(zip(edges[:-1], edges[1:], strict=True))
    out = {
        "bucket": pa.array([int(place[a]) for a, _ in rows], pa.int32()),
        "shard": pa.array([shard] * len(rows), pa.int32()),
        "hashes": pa.array([hashes[a:b].tobytes() for a, b in rows], pa.binary()),
    }
    for name, values in columns.items():
        out[name] = pa.array([values[a:b].tobytes() for a, b in rows], pa.binary())
    return pa.table(out)


def unpacked(table: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column, and the edges between its rows."""
    blobs = table.column(name).to_pylist()
    sizes = [len(b) // np.dtype(kind).itemsize for b in blobs]
    return np.frombuffer(b"".join(blobs), kind), np.r_[0, np.cumsum(sizes)].astype(np.int64)


def answers(table: pa.Table, edges: np.ndarray, bits: np.ndarray, level: int) -> pa.Table:
    """(shard, level, bucket, bits): each row of a bucket gets its own bits back."""
    out = [np.packbits(bits[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    n = len(out)
    return pa.table({"shard": table.column("shard"), "level": pa.array([level] * n, pa.int32()), "bucket": table.column("bucket"), "bits": pa.array(out, pa.binary())})


ANSWER = "shard int, level int, bucket int, bits binary"


def answered(replies: pa.Table, level: int, hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bits of sorted hashes, put together from the buckets' answers of a level."""
    counts = np.bincount(buckets_of(hashes, n_buckets), minlength=n_buckets) if len(hashes) else np.zeros(n_buckets, np.int64)
    rows = {r["bucket"]: r["bits"] for r in replies.to_pylist() if r["level"] == level}
    parts = [np.unpackbits(np.frombuffer(rows[b], np.uint8), count=counts[b]) for b in np.flatnonzero(counts)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def recurring(level: int):
    """For the rows of one bucket: whether a hash is named by two shards, or by one as occurring twice (``many``)."""

    def run(table: pa.Table) -> pa.Table:
        hashes, edges = unpacked(table, "hashes", np.uint64)
        many, _ = unpacked(table, "many", np.uint8)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        new = np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        hit = np.add.reduceat(1 + many[order].astype(np.int64), first) > 1 if len(first) else np.zeros(0, bool)
        bits = np.zeros(len(hashes), np.uint8)
        bits[order] = np.repeat(hit, np.diff(np.r_[first, len(ranked)]))
        return answers(table, edges, bits, level)

    return run


def member(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Place of each value in sorted distinct values that contain them all."""
    return np.searchsorted(ranked, values)
