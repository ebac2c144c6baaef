"""Token counts of a byte-level byte-pair vocabulary by heap-and-linked-list merging.

A piece of text starts as a linked list of byte symbols. A heap holds the adjacent pairs that the vocabulary merges, by
rank and place; popping the lowest joins two symbols and offers the two pairs that the new symbol makes with its
neighbours. The count is the number of symbols minus the number of merges: no identifier is looked up or returned.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm.words import byte_count

# The split of text before merging, as byte-level vocabularies of this family define it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

CACHE_PIECES = 500_000
CACHE_CHARS = 48
PAIR_BITS = 24
PLACE_BITS = 40
PLACE_MASK = (1 << PLACE_BITS) - 1


def byte_symbols() -> dict[int, str]:
    """Byte -> the character that stands for it in the vocabulary file: printable bytes for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class MergeCounter(dict):
    """Counts tokens; as a dictionary it remembers the counts of short pieces, and is emptied when it is full.

    Symbols are numbered by their strings. ``ranks`` has the rank of a pair under one number for both, ``joined`` the symbol
    that a rank makes; a heap entry is rank and place in one number.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        merges = [m.split(" ") if isinstance(m, str) else m for m in vocabulary["model"]["merges"]]
        number: dict[str, int] = {}
        self.start = [number.setdefault(c, b) for b, c in sorted(byte_symbols().items())]
        self.joined = [number.setdefault(left + right, len(number)) for left, right in merges]
        pairs = [number[left] << PAIR_BITS | number[right] for left, right in merges]
        self.ranks = {pair: rank for rank, pair in reversed(list(enumerate(pairs)))}
        special = [t["content"] for t in vocabulary.get("added_tokens", []) if t["special"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.pieces = regex.compile(SPLIT).findall

    def merged(self, piece: str) -> int:
        start, rank_of, joined = self.start, self.ranks.get, self.joined
        parts = [start[b] for b in piece.encode("utf-8", "surrogatepass")]
        end = count = len(parts)
        heap = []
        for i in range(end - 1):
            rank = rank_of(parts[i] << PAIR_BITS | parts[i + 1])
            if rank is not None:
                heap.append(rank << PLACE_BITS | i)
        if not heap:
            return count
        heapify(heap)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        while heap:
            entry = heappop(heap)
            rank, i = entry >> PLACE_BITS, entry & PLACE_MASK
            left, j = parts[i], after[i]
            if left < 0 or j >= end or rank_of(left << PAIR_BITS | parts[j]) != rank:
                continue
            parts[i] = left = joined[rank]
            parts[j] = -1
            after[i] = k = after[j]
            count -= 1
            if k < end:
                before[k] = i
                rank = rank_of(left << PAIR_BITS | parts[k])
                if rank is not None:
                    heappush(heap, rank << PLACE_BITS | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(parts[h] << PAIR_BITS | left)
                if rank is not None:
                    heappush(heap, rank << PLACE_BITS | h)
        return count

    def __missing__(self, piece: str) -> int:
        n = self.merged(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = n
        return n

    def plain(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pieces(text)))

    def count(self, text: str | None) -> int:
        """Tokens of a text; each special string inside it is one token, and cuts the text."""
        if not text:
            return 0
        if self.special is None or self.special.search(text) is None:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.plain(p) for p in parts if p)


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One counter for each worker process and vocabulary."""
    return MergeCounter(path)


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; ``vocabulary`` is a path that every executor has.

    A narrow map: nothing is shuffled and a batch of rows is all that a worker holds.
    Cases: null and empty text: 0 tokens; repeated rows and null keys stay; empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in batches:
            n = pa.array([count(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    body = F.col(f"`{text}`")
    rows = documents.select(F.col(f"`{key}`").alias("doc_id"), byte_count(body).alias("n_bytes"), body.cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
