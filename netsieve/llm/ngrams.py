"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted arrays, memory-mapped by the workers that score.

A word w after v has
    P(w | v) = (c(v, w) - D(c(v, w))) / c(v) + g(v) * P(w)          g(v) = (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v)
    P(w)     = (k(w) - E(k(w))) / K          + g   * 1 / (V + 1)    g    = (E1 q1 + E2 q2 + E3 q3) / K
with c counts of training tokens, n1, n2, n3 the numbers of different words that follow v once, twice and more often, k(w) the number of
different words before w and K their sum, V the number of distinct tokens, and discounts D, E of counts of 1, 2 and more from counts of
counts. An unknown v leaves P(w). A text is its words and one end; its first word follows a start mark.

The model is a folder of flat files below the shared folder, of three kinds:
- ``words-b``: the sorted 64-bit hashes of the words of bucket b (a range of hashes). A word's place over all buckets is its number, so
  numbers are dense and what is known of words is flat arrays: ``count``, ``before`` (k), ``once``, ``twice``, ``more``.
- ``pairs-p``: the sorted keys (second word, first word) of a bucket of pairs, and ``times-p``, their counts. A bucket holds consecutive second
  words of about ``PAIR_TOKENS`` tokens; a word with more tokens has several buckets, by its first words, so no word makes a large task.
- ``plan-*``, ``sums``: where buckets begin, totals and discounts.

Workers map the files and look up sorted batches, so a batch touches the pages that hold its words, memory is the operating system's
cache, and nothing of the model passes through the driver or a broadcast. The shared folder must be one that tasks can open as files.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve.llm import recurrence as R
from netsieve.operators.sizing import scratch_path

START = np.uint64(0x6A09E667F3BCC909)
END = np.uint64(0xBB67AE8584CAA73B)
HEAD_MARK = np.uint64(0xA5A5A5A55A5A5A5A)
WORD_BYTES = 32 << 20  # bytes of text for one bucket of words
PAIR_TOKENS = 4_000_000  # training tokens for one bucket of pairs
CHUNK_TOKENS = 2_000_000  # tokens that a task counts or scores at once
FIRST_BITS = np.uint64(40)  # bits of the first word's number in the key of a pair
LAW = np.uint64(R.BASE)


def held_out(key: Column, share: int = 7, part: int = 2) -> Column:
    """Documents that are not learned from: CRC-32 of the key as text, modulo ``share``, is ``part``; null keys are learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(share)) == part, F.lit(False))


class Spelling(NamedTuple):
    """Words seen fewer than ``frequent`` times in a stored vocabulary are known by their first ``head`` bytes, so that rare forms of one stem are one token."""

    folder: str
    frequent: int
    head: int

    def symbols(self, data: np.ndarray, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        model = stored_model(self.folder)
        distinct, at = np.unique(words, return_inverse=True)
        numbers = model.numbers(distinct)
        known = np.flatnonzero(numbers >= 0)
        known = known[np.argsort(numbers[known], kind="stable")]
        often = np.zeros(len(distinct), bool)
        often[known] = model.facts("count", numbers[known]) >= self.frequent
        heads = R.Sums.of(R.BYTE_VALUES[data]).stretches(start, np.minimum(end, start + self.head)) ^ HEAD_MARK
        return np.where(often[at], words, heads)


@lru_cache(maxsize=8)
def stored_model(folder: str) -> Model:
    return Model(folder)


def tokens(texts: list[bytes], spelling: Spelling | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of start, words and end of each text, one after another, and the edges between texts."""
    parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for first, last, data, bounds in R.pieces(texts):
        words, at, until = R.word_symbols(data)
        words = spelling.symbols(data, words, at, until) if spelling is not None else words
        edges = np.searchsorted(at, bounds)
        n = np.diff(edges)
        out = np.empty(len(words) + 2 * (last - first), np.uint64)
        shift = 2 * np.arange(last - first)
        out[edges[:-1] + shift] = START
        out[edges[1:] + shift + 1] = END
        out[np.arange(len(words)) + np.repeat(shift, n) + 1] = words
        parts.append(out)
        sizes.append(n + 2)
    return np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(sizes))]


def chunks(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Consecutive rows of about ``CHUNK_TOKENS`` tokens (by bytes) with their texts in lower case (A-Z only)."""
    rows: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        own = [(t.as_py() or "").encode("utf-8", "surrogatepass").lower() for t in batch.column(place)]
        at = 0
        while at < len(own):
            to = at
            while to < len(own) and size < 6 * CHUNK_TOKENS:
                size += len(own[to]) + 1
                to += 1
            rows.append(batch.slice(at, to - at))
            texts += own[at:to]
            at = to
            if size >= 6 * CHUNK_TOKENS:
                yield pa.Table.from_batches(rows), texts
                rows, texts, size = [], [], 0
    if texts:
        yield pa.Table.from_batches(rows), texts


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers (0 or more) in the fewest bytes."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max))


def pack(values: np.ndarray) -> bytes:
    small = narrow(values)
    return bytes([small.itemsize]) + small.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"u{blob[0]}", offset=1).astype(np.int64)


def local_path(uri: str) -> str:
    """The folder as tasks can open it; memory maps need a mounted path."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model is memory-mapped: name a mounted folder in spark.checkpoint.dir, not {uri}")
    return parts.path


def put(folder: str, name: str, values: np.ndarray) -> None:
    """Written aside and renamed, so that a repeated task replaces a whole file by the same whole file."""
    os.makedirs(folder, exist_ok=True)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(aside, "wb") as file:
        np.save(file, values)
    os.replace(aside, f"{folder}/{name}.npy")


class Plan(NamedTuple):
    """Words before each bucket of words; and for pairs: first second-word, first bucket and number of buckets of each range."""

    first: np.ndarray
    start: np.ndarray
    bucket: np.ndarray
    parts: np.ndarray

    def pairs(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and key of pairs of word numbers."""
        r = np.searchsorted(self.start, word, side="right") - 1
        deal = (R.mixed(before.astype(np.uint64) * LAW) >> np.uint64(33)).astype(np.int64) % self.parts[r]
        key = ((word - self.start[r]).astype(np.uint64) << FIRST_BITS) | before.astype(np.uint64)
        return self.bucket[r] + deal, key


class Model:
    """A stored model, mapped into memory file by file as it is asked."""

    def __init__(self, folder: str):
        self.folder = folder
        self.plan = Plan(*[self.array(f"plan-{k}") for k in Plan._fields])
        self.array = lru_cache(maxsize=4096)(self.array)  # open files

    def array(self, name: str) -> np.ndarray | None:
        path = f"{self.folder}/{name}.npy"
        return np.load(path, mmap_mode="r") if os.path.exists(path) and os.path.getsize(path) > 128 else np.load(path) if os.path.exists(path) else None

    def sums(self) -> dict:
        with open(f"{self.folder}/sums.json", encoding="utf-8") as file:
            return json.load(file)

    def numbers(self, ranked: np.ndarray) -> np.ndarray:
        """Numbers of sorted distinct word hashes; -1 for unknown ones."""
        n = len(self.plan.first) - 1
        edges = np.searchsorted(R.buckets_of(ranked, n), np.arange(n + 1))
        out = np.full(len(ranked), -1, np.int64)
        for b in np.flatnonzero(np.diff(edges)):
            own = self.array(f"words-{b}")
            if own is not None and len(own):
                part = ranked[edges[b] : edges[b + 1]]
                at = np.minimum(np.searchsorted(own, part), len(own) - 1)
                out[edges[b] : edges[b + 1]] = np.where(own[at] == part, self.plan.first[b] + at, -1)
        return out

    def facts(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """A flat array's values at sorted known word numbers."""
        edges = np.searchsorted(numbers, self.plan.first)
        out = np.zeros(len(numbers), np.int64)
        for b in np.flatnonzero(np.diff(edges)):
            own = self.array(f"{name}-{b}")
            if own is not None:
                out[edges[b] : edges[b + 1]] = own[numbers[edges[b] : edges[b + 1]] - self.plan.first[b]]
        return out

    def times(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Counts of pairs of known words."""
        bucket, key = self.plan.pairs(before, word)
        order = np.lexsort((key, bucket))
        bucket, key = bucket[order], key[order]
        edges = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True]) if len(bucket) else np.zeros(1, np.int64)
        found = np.zeros(len(key), np.int64)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = self.array(f"pairs-{bucket[a]}")
            if own is not None and len(own):
                at = np.minimum(np.searchsorted(own, key[a:b]), len(own) - 1)
                found[a:b] = np.where(own[at] == key[a:b], self.array(f"times-{bucket[a]}")[at], 0)
        out = np.empty(len(key), np.int64)
        out[order] = found
        return out


def discounts(of_counts: list[int]) -> list[float]:
    """Discounts of counts of 0, 1, 2 and more from the numbers of counts of 1 to 4; fixed ones where these give none between 0 and the count."""
    n1, n2, n3, n4 = of_counts
    if min(of_counts) > 0:
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 < d < k for k, d in enumerate(found, 1)):
            return [0.0, *found]
    return [0.0, 0.5, 1.0, 1.5]


def _grouped(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the sums of their weights."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
    return ranked[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)


def _slices(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of each run of equal buckets."""
    edges = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True]) if len(bucket) else np.zeros(1, np.int64)
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


WORD_ROWS = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
WORD_SUMS = pa.schema([("bucket", pa.int32()), ("words", pa.int64()), ("tokens", pa.int64()), ("distinct", pa.int64()), ("start", pa.binary()), ("parts", pa.binary())])
PAIR_ROWS = pa.schema([("bucket", pa.int32()), ("word", pa.binary()), ("before", pa.binary()), ("counts", pa.binary())])
SUM_FIELDS = ("k", "q1", "q2", "q3", "q4", "t1", "t2", "t3", "t4")
DDL = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}


def fact_rows(caps: tuple[int, ...]) -> pa.Schema:
    """What a bucket of pairs tells of words; with ``caps``, also sums of counts up to each cap."""
    names = ("numbers", "once", "twice", "more", *[f"upto{d}" for d in caps], "words", "before", "t")
    return pa.schema([("bucket", pa.int32()), *[(k, pa.binary()) for k in names]])


def sum_rows(caps: tuple[int, ...]) -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), *[(k, pa.int64()) for k in (*SUM_FIELDS, *[f"upto{d}" for d in caps])]])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {DDL[f.type]}" for f in schema)


def count_words(texts: DataFrame, folder: str, n_buckets: int, pair_tokens: int, spelling: Spelling | None = None) -> DataFrame:
    """Writes words and counts of every bucket; a row for each bucket with its size and how its pairs are dealt."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in chunks(batches, 0):
            hashes, counts = np.unique(tokens(own, spelling)[0], return_counts=True)
            rows = [{"bucket": b, "hashes": hashes[x:y].tobytes(), "counts": pack(counts[x:y])} for b, x, y in _slices(R.buckets_of(hashes, n_buckets))]
            yield _table(rows, WORD_ROWS)

    def settle(group: pa.Table) -> pa.Table:
        b = group.column("bucket")[0].as_py()
        hashes = np.concatenate([np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()])
        words, counts = _grouped(hashes, np.concatenate([unpack(c) for c in group.column("counts").to_pylist()]))
        put(folder, f"words-{b}", words)
        put(folder, f"count-{b}", narrow(counts))
        own = np.where(words == START, 0, counts)
        hot = own > pair_tokens
        label = np.cumsum(np.where(hot, 0, own)) // pair_tokens
        cut = np.r_[True, (label[1:] != label[:-1]) | hot[1:] | hot[:-1]]
        start = np.flatnonzero(cut)
        parts = np.maximum(1, -(-own[start] // pair_tokens))
        return pa.table(
            {"bucket": [b], "words": [len(words)], "tokens": [int(own.sum())], "distinct": [int((own > 0).sum())], "start": [pack(start)], "parts": [pack(parts)]},
            schema=WORD_SUMS,
        )

    return texts.mapInArrow(name, ddl(WORD_ROWS)).groupBy("bucket").applyInArrow(settle, ddl(WORD_SUMS))


def count_pairs(texts: DataFrame, folder: str, spelling: Spelling | None = None, caps: tuple[int, ...] = ()) -> DataFrame:
    """Writes the pairs of every bucket, then what they tell of words; a row of sums for each bucket of words."""

    levels = ("once", "twice", "more", *[f"upto{d}" for d in caps])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(folder)
        for _, own in chunks(batches, 0):
            sequence, edges = tokens(own, spelling)
            distinct, at = np.unique(sequence, return_inverse=True)
            second = np.ones(len(at), bool)
            second[edges[:-1]] = False
            code = at[np.flatnonzero(second) - 1] * len(distinct) + at[second]
            code, counts = np.unique(code, return_counts=True)
            numbers = model.numbers(distinct)
            before, word = numbers[code // len(distinct)], numbers[code % len(distinct)]
            bucket, key = model.plan.pairs(before, word)
            order = np.lexsort((key, bucket))
            bucket, key, counts = bucket[order], key[order], counts[order]
            high, low = (key >> FIRST_BITS).astype(np.int64), (key & ((np.uint64(1) << FIRST_BITS) - np.uint64(1))).astype(np.int64)
            rows = [
                {"bucket": b, "word": pack(np.diff(high[x:y], prepend=0)), "before": pack(low[x:y]), "counts": pack(counts[x:y])}
                for b, x, y in _slices(bucket)
            ]
            yield _table(rows, PAIR_ROWS)

    def settle(group: pa.Table) -> pa.Table:
        plan = Model(folder).plan
        b = group.column("bucket")[0].as_py()
        high = np.concatenate([np.cumsum(unpack(w)) for w in group.column("word").to_pylist()])
        low = np.concatenate([unpack(v) for v in group.column("before").to_pylist()])
        keys, counts = _grouped((high.astype(np.uint64) << FIRST_BITS) | low.astype(np.uint64), np.concatenate([unpack(c) for c in group.column("counts").to_pylist()]))
        put(folder, f"pairs-{b}", keys)
        put(folder, f"times-{b}", narrow(counts))
        before = (keys & ((np.uint64(1) << FIRST_BITS) - np.uint64(1))).astype(np.int64)
        r = np.searchsorted(plan.bucket, b, side="right") - 1
        words, befores = _grouped((keys >> FIRST_BITS).astype(np.int64) + plan.start[r], np.ones(len(keys), np.int64))
        told = [_grouped(before, part.astype(np.int64)) for part in (counts == 1, counts == 2, counts > 2, *[np.minimum(counts, d) for d in caps])]
        numbers = told[0][0]
        at = np.searchsorted(numbers, plan.first)
        own = int(np.searchsorted(plan.first, plan.start[r], side="right") - 1)
        rows = [
            {"bucket": int(w), "numbers": pack(numbers[at[w] : at[w + 1]] - plan.first[w])}
            | {k: pack(told[i][1][at[w] : at[w + 1]]) for i, k in enumerate(levels)}
            for w in np.flatnonzero(np.diff(at))
        ]
        rows.append({"bucket": own, "words": pack(words - plan.first[own]), "before": pack(befores), "t": pack(np.array([(counts == k).sum() for k in (1, 2, 3, 4)]))})
        return pa.Table.from_pylist(rows, fact_rows(caps))

    def gather(group: pa.Table) -> pa.Table:
        plan = Model(folder).plan
        b = group.column("bucket")[0].as_py()
        size = int(plan.first[b + 1] - plan.first[b])
        facts = {k: np.zeros(size, np.int64) for k in (*levels, "before")}
        t = np.zeros(4, np.int64)
        for row in group.to_pylist():
            if row["numbers"] is not None:  # numbers of one row are distinct
                at = unpack(row["numbers"])
                for k in levels:
                    facts[k][at] += unpack(row[k])
            else:
                facts["before"][unpack(row["words"])] += unpack(row["before"])
                t += unpack(row["t"])
        for k, values in facts.items():
            put(folder, f"{k}-{b}", narrow(values))
        k = facts["before"]
        sums = [int(k.sum()), *[int((k == n).sum()) for n in (1, 2, 3, 4)], *t.tolist(), *[int(np.minimum(k, d).sum()) for d in caps]]
        return pa.table({f: [v] for f, v in zip(sum_rows(caps).names, [b, *sums], strict=True)}, schema=sum_rows(caps))

    rows = texts.mapInArrow(name, ddl(PAIR_ROWS)).groupBy("bucket").applyInArrow(settle, ddl(fact_rows(caps)))
    return rows.groupBy("bucket").applyInArrow(gather, ddl(sum_rows(caps)))


def fit(
    documents: DataFrame,
    text: str = "text",
    word_bytes: int = WORD_BYTES,
    pair_tokens: int = PAIR_TOKENS,
    spelling: Spelling | None = None,
    only_words: bool = False,
    caps: tuple[int, ...] = (),
) -> str:
    """Counts the model of all texts (with ``only_words`` just its words) and returns its folder. ``caps`` are absolute discounts that it may be asked with. The driver gets a row for each bucket of words (sizes, and 12 bytes for each bucket of
    pairs), which it writes into the folder as well. Every task writes whole files under fixed names, so it can be repeated."""
    body = F.col(f"`{text}`").cast("string").alias("text")
    texts = documents.select(body)
    folder = local_path(scratch_path(documents.sparkSession, "ngrams"))
    os.makedirs(folder)
    total = texts.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    n_buckets = max(8, math.ceil(total / word_bytes))
    found = {r.bucket: r for r in count_words(texts, folder, n_buckets, pair_tokens, spelling).collect()}
    sizes = [found[b].words if b in found else 0 for b in range(n_buckets)]
    first = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    some = sorted(found)
    start = np.concatenate([first[b] + unpack(bytes(found[b].start)) for b in some]) if some else np.zeros(1, np.int64)
    parts = np.concatenate([unpack(bytes(found[b].parts)) for b in some]) if some else np.ones(1, np.int64)
    bucket = np.r_[0, np.cumsum(parts)[:-1]].astype(np.int64)
    for name, values in zip(Plan._fields, (first, start, bucket, parts), strict=True):
        put(folder, f"plan-{name}", values)
    if only_words:
        return folder
    rows = count_pairs(texts, folder, spelling, caps).collect()
    sums = {f: sum(r[f] for r in rows) for f in sum_rows(caps).names[1:]}
    sums |= {"tokens": sum(r.tokens for r in found.values()), "distinct": sum(r.distinct for r in found.values())}
    sums |= {"D": discounts([sums[f"t{k}"] for k in (1, 2, 3, 4)]), "E": discounts([sums[f"q{k}"] for k in (1, 2, 3, 4)])}
    with open(f"{folder}/sums.json", "w", encoding="utf-8") as file:
        json.dump(sums, file)
    return folder


class Law(NamedTuple):
    """What a model says of distinct tokens and of pairs of them: P(w) = own(w) + spare x 1 / (V + 1), P(w | v) = direct(v, w) + back(v) x P(w)."""

    count: np.ndarray
    before: np.ndarray
    own: np.ndarray
    spare: float
    back: np.ndarray
    direct: np.ndarray

    @classmethod
    def of(cls, model: Model, sums: dict, distinct: np.ndarray, before: np.ndarray, word: np.ndarray, cap: int | None = None) -> Law:
        """``before`` and ``word`` are places in ``distinct``, one of each for a pair. With ``cap``, counts are discounted by as much of them as is within it."""
        numbers = model.numbers(distinct)
        known = numbers >= 0
        order = np.argsort(numbers[known], kind="stable")
        facts = {}
        for name in ("count", "before", *(("once", "twice", "more") if cap is None else (f"upto{cap}",))):
            values, own = np.zeros(len(distinct), np.int64), np.empty(len(order), np.int64)
            own[order] = model.facts(name, numbers[known][order])
            values[known] = own
            facts[name] = values
        d, e, k, count = np.array(sums["D"]), np.array(sums["E"]), facts["before"], facts["count"]
        less = (lambda c, law: law[np.minimum(c, 3)]) if cap is None else (lambda c, law: np.minimum(c, cap))
        if cap is None:
            spare = e[1] * sums["q1"] + e[2] * sums["q2"] + e[3] * (sums["distinct"] - sums["q1"] - sums["q2"])
            spread = d[1] * facts["once"] + d[2] * facts["twice"] + d[3] * facts["more"]
        else:
            spare, spread = sums[f"upto{cap}"], facts[f"upto{cap}"]
        spare = spare / sums["k"] if sums["k"] else 1.0
        own = (k - less(k, e)) / max(sums["k"], 1)
        back = np.where(count > 0, spread / np.maximum(count, 1), 1.0)
        direct = np.zeros(len(before))
        both = known[before] & known[word]
        c = model.times(numbers[before[both]], numbers[word[both]])
        direct[both] = (c - less(c, d)) / np.maximum(count[before[both]], 1)
        return cls(count, k, own, spare, back, direct)


def pairs_of(sequence: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct tokens; distinct pairs as places in them (before, word); for each token but the starts its pair; and where each text's begin."""
    distinct, at = np.unique(sequence, return_inverse=True)
    second = np.ones(len(at), bool)
    second[edges[:-1]] = False
    place = np.flatnonzero(second)
    code, pair = np.unique(at[place - 1] * len(distinct) + at[place], return_inverse=True)
    return distinct, code // max(len(distinct), 1), code % max(len(distinct), 1), pair, edges[:-1] - np.arange(len(edges) - 1)


def log_scores(model: Model, sums: dict, sequence: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, base_score, score of each text of ``tokens``."""
    distinct, before, word, pair, first = pairs_of(sequence, edges)
    law = Law.of(model, sums, distinct, before, word)
    n, v = sums["tokens"], sums["distinct"]
    logs = np.log10(law.direct + law.back[before] * (law.own + law.spare / (v + 1))[word])
    counts = np.where(distinct == START, 0, law.count)
    base = np.log10((counts + 1) / (n + 1 * (v + 1)))
    at, add = word[pair], np.add.reduceat
    return np.diff(edges) - 1, add((counts > 0)[at].astype(np.int64), first), add(base[at], first), add(logs[pair], first)


def score(documents: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score (log10 probability) and perplexity of every whole text under a stored model."""
    rows = documents.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(folder)
        sums = model.sums()
        for table, own in chunks(batches, 1):
            n, known, base, logs = log_scores(model, sums, *tokens(own))
            train = np.full(len(n), sums["tokens"], np.int64)
            with np.errstate(over="ignore"):
                columns = [pa.array(c) for c in (n, known, train, base, logs, np.power(10.0, -logs / n))]
            yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), *columns], names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def language_scores(documents: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every document, under the model of those not held out.

    Cases: null and empty texts are one end; null keys stay and are learned from; repeated rows count and stay; long texts are counted
    whole; ties cannot occur; without training documents every token has probability 1 / (0 + 1); empty table: no rows; further columns are left out.
    """
    folder = fit(documents.filter(~held_out(F.col(f"`{key}`"))), text, **options)
    out = score(documents, folder, key, text)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *out.columns[1:])
