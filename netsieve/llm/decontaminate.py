"""Benchmark decontamination: edit distance by random-walk embedding, bit-sampling LSH and exact verification.

Distances count words (lower case, without ASCII punctuation). The random walk (CGK) reads a sequence from left to right; at each step it writes the
current word and, by a random bit of step and word, stays or moves on. Two sequences at small edit distance give outputs at small Hamming
distance, because their walks meet again after an edit. Outputs of equal length are compared by bit sampling: ``SAMPLES``
positions of the output make a key, and ``REPEATS`` independent walks are tried, so that a window at the limit collides in one of them with the
target recall (tests/llm measures it).

Windows have the size of an item: positions are sampled from the steps that the item's own walk fills. Windows are taken at every word
from which an item within the limit can start: an item of n words within ``0.2 n`` edits keeps one of ``0.2 n + 1`` pieces unchanged, so
windows without any such piece are not embedded. Colliding windows are verified by exact edit distance (bit-parallel, with free ends).
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import recurrence as R
from netsieve.llm.words import normal_bytes

SIMILARITY = 0.8
REPEATS = 56
SAMPLES = 2
BLOCK_ITEMS = 10_000
CLASS_STEP = 1.3
WALK_BATCH = 1 << 10
FILTER_BITS = 20


class Block(NamedTuple):
    """Part of the benchmark with what a task needs to search for it."""

    ids: list
    words: list[list[bytes]]
    pieces: dict[int, tuple[np.ndarray, int, np.ndarray]]  # piece length -> sorted hashes of such pieces, how far before one an item can start, bit table
    classes: list[tuple[int, np.ndarray]]  # class length, sampled steps of each repeat
    keys: np.ndarray  # sorted keys of all items, by class and repeat
    items: np.ndarray  # item of each key


def allowed(n: int, similarity: float) -> int:
    """Edits at which an item of n words still counts."""
    return int(n * (1 - similarity) + 1e-9)


def class_length(n: int) -> int:
    """Largest class length that is at most n; lengths grow by ``CLASS_STEP``."""
    length = 1
    while max(length + 1, int(length * CLASS_STEP)) <= n:
        length = max(length + 1, int(length * CLASS_STEP))
    return length


def coins(repeats: int, steps: int) -> np.ndarray:
    """[repeat, step] -> odd number. Drawn step by step: a walk of fewer steps has the same coins as the start of a longer one."""
    return np.random.default_rng(7).integers(1, 1 << 63, (steps, repeats), dtype=np.uint64).T * np.uint64(2) + np.uint64(1)


def sampled(length: int, repeats: int, samples: int) -> np.ndarray:
    """Steps of each repeat's sample, from the steps in which a walk stays inside ``length`` words."""
    rng = np.random.default_rng(1000 + length)
    return np.sort(rng.integers(0, max(1, int(1.5 * length)), (repeats, samples)), axis=1)


def walks(symbols: np.ndarray, starts: np.ndarray, coin: np.ndarray) -> np.ndarray:
    """[step, repeat, start] -> what the walk of a repeat writes. Beyond the last symbol it writes 0."""
    padded = np.r_[symbols, np.uint64(0)]
    end = len(symbols)
    repeats, steps = coin.shape
    at = np.repeat(starts[None, :], repeats, axis=0)
    out = np.empty((steps, repeats, len(starts)), np.uint64)
    for t in range(steps):
        out[t] = padded[at]
        at += ((out[t] * coin[:, t : t + 1]) >> np.uint64(63)).astype(np.int64)
        np.minimum(at, end, out=at)
    return out


def keys_of(written: np.ndarray, steps: np.ndarray, length: int) -> np.ndarray:
    """[repeat, start] -> key of the sampled steps; keys of different classes and repeats do not meet."""
    repeats = np.arange(len(steps))
    key = np.repeat(R.mixed((length * 4096 + repeats + 1).astype(np.uint64) * np.uint64(R.BASE))[:, None], written.shape[2], axis=1)
    for k in range(steps.shape[1]):
        key = R.mixed(key * np.uint64(R.BASE) + written[steps[:, k], repeats])
    return key


def piece_length(n: int, similarity: float) -> int:
    return max(1, n // (allowed(n, similarity) + 1))


def prepare(ids: list, texts: list[str | None], similarity: float = SIMILARITY, repeats: int = REPEATS, samples: int = SAMPLES) -> Block:
    """Search structures of benchmark items; items without words are left out."""
    own = [(i, normal_bytes(t).split()) for i, t in zip(ids, texts, strict=True)]
    own = [(i, w) for i, w in own if w]
    by_piece: dict[int, list[np.ndarray]] = defaultdict(list)
    reach: dict[int, int] = defaultdict(int)
    by_class: dict[int, list[int]] = defaultdict(list)
    symbols = []
    for k, (_, words) in enumerate(own):
        hashes = R.word_symbols(np.frombuffer(b" ".join(words) + b" ", np.uint8))[0]
        symbols.append(hashes)
        size = piece_length(len(words), similarity)
        by_piece[size].append(R.Sums.of(hashes).grams(size))
        reach[size] = max(reach[size], len(words) + allowed(len(words), similarity))
        by_class[class_length(len(words))].append(k)
    classes, keys, items = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for length in sorted(by_class):
        steps = sampled(length, repeats, samples)
        classes.append((length, steps))
        coin = coins(repeats, int(steps.max()) + 1)
        for k in by_class[length]:
            keys.append(keys_of(walks(symbols[k], np.zeros(1, np.int64), coin), steps, length)[:, 0])
            items.append(np.full(repeats, k))
    key, item = np.concatenate(keys), np.concatenate(items)
    order = np.argsort(key, kind="stable")
    pieces = {}
    for n, hashes in by_piece.items():
        ranked = np.unique(np.concatenate(hashes))
        table = np.zeros(1 << FILTER_BITS, bool)
        table[ranked >> np.uint64(64 - FILTER_BITS)] = True
        pieces[n] = (ranked, reach[n], table)
    return Block([i for i, _ in own], [w for _, w in own], pieces, classes, key[order], item[order])


def _in(ranked: np.ndarray, wanted: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of the values that occur in ``ranked``: a bit table rules out most, the sorted array decides."""
    maybe = np.flatnonzero(table[wanted >> np.uint64(64 - FILTER_BITS)])
    at = np.minimum(np.searchsorted(ranked, wanted[maybe]), len(ranked) - 1)
    return maybe[ranked[at] == wanted[maybe]]


def window_starts(block: Block, words: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Words at which a window may start: within reach before a piece of an item, in the same document."""
    change = np.zeros(len(words) + 1, np.int64)
    sums = R.Sums.of(words)
    for size, (ranked, reach, table) in block.pieces.items():
        hit = _in(ranked, sums.grams(size), table)
        doc = np.searchsorted(edges, hit, side="right") - 1
        hit, doc = hit[hit + size <= edges[doc + 1]], doc[hit + size <= edges[doc + 1]]
        np.add.at(change, np.maximum(hit - reach, edges[doc]), 1)
        np.add.at(change, hit + 1, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def collisions(block: Block, words: np.ndarray, starts: np.ndarray, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, item) of the windows that share a key with an item."""
    at, item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    most = max((int(s.max()) + 1 for _, s in block.classes), default=0)
    coin = coins(repeats, most)
    for lo in range(0, len(starts), WALK_BATCH):
        part = starts[lo : lo + WALK_BATCH]
        a = int(part[0])
        written = walks(words[a : min(len(words), int(part[-1]) + most + 1)], part - a, coin)
        for length, sample in block.classes:
            keys = keys_of(written, sample, length)
            place = np.minimum(np.searchsorted(block.keys, keys), len(block.keys) - 1)
            hit = block.keys[place] == keys
            first = place[hit]
            count = np.searchsorted(block.keys, keys[hit], side="right") - first
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at.append(np.repeat(np.broadcast_to(part, keys.shape)[hit], count))
            item.append(block.items[np.repeat(first, count) + inner])
    found = np.unique(np.stack([np.concatenate(item), np.concatenate(at)], 1), axis=0)
    return found[:, 1], found[:, 0]


def edit_search(item: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """Least number of word edits between the item and any stretch of the text, and where the first such stretch ends."""
    n = len(item)
    where: dict[bytes, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, end = full, 0, n, n, 0
    for k, w in enumerate(text):
        eq = where.get(w, 0)
        x = eq | down
        d = ((x & up) + up ^ up) | x
        right = down_h = d & up
        right = down | (full & ~(d | up))
        score += 1 if right & top else 0
        score -= 1 if down_h & top else 0
        right = right << 1 & full
        down_h = down_h << 1 & full
        up = down_h | (full & ~(d | right))
        down = right & d
        if score < best:
            best, end = score, k + 1
    return best, end


def matches(block: Block, texts: list[bytes], similarity: float, repeats: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, edits, first word, end) of the best stretch of each text for each item within the limit."""
    for first, _, data, bounds in R.pieces(texts):
        words, begin, end = R.word_symbols(data)
        edges = np.searchsorted(begin, bounds)
        starts = window_starts(block, words, edges)
        if not len(starts):
            continue
        at, item = collisions(block, words, starts, repeats)
        doc = np.searchsorted(edges, at, side="right") - 1
        order = np.lexsort((at, item, doc))
        at, item, doc = at[order], item[order], doc[order]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        k = 0
        while k < len(at):
            own = (int(doc[k]), int(item[k]))
            target = block.words[own[1]]
            limit = allowed(len(target), similarity)
            last = k
            while last + 1 < len(at) and (doc[last + 1], item[last + 1]) == own and at[last + 1] - at[last] <= len(target):
                last += 1
            lo, hi = max(int(at[k]) - limit, int(edges[own[0]])), min(int(at[last]) + len(target) + limit, int(edges[own[0] + 1]))
            text = [data[begin[i] : end[i]].tobytes() for i in range(lo, hi)]
            edits, stop = edit_search(target, text)
            if edits <= limit and (own not in best or edits < best[own][0]):
                back = edit_search(target[::-1], text[:stop][::-1])
                best[own] = (edits, lo + stop - back[1] - int(edges[own[0]]), lo + stop - int(edges[own[0]]))
            k = last + 1
        for (d, i), (edits, a, b) in best.items():
            yield first + d, i, edits, a, b


def contamination(
    documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, repeats: int = REPEATS, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """doc_id, item_id, edits, similarity, start_word, end_word: for each document and item the best stretch within the limit.

    The benchmark is a stated query set. It is taken in blocks of at most ``block_items`` items, each block is searched in one narrow scan of the
    documents: nothing is shuffled, and no more than a block is sent out. Words are counted after normalising.
    Cases: null or wordless texts and items match nothing; null keys stay; repeated rows and repeated items give rows of their own; empty tables: no rows.
    """
    doc_kind = documents.select(F.col(f"`{key}`").alias("k")).schema["k"].dataType.simpleString()
    items = benchmark.select(F.col(f"`{item_key}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    item_type = items.schema["item_id"].dataType
    schema = f"doc_id {doc_kind}, item_id {item_type.simpleString()}, edits long, similarity double, start_word long, end_word long"
    rows = documents.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block: Block = Block(*pickle.loads(shared.value))
            kinds = [None, None, pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            for batch in batches:
                keys = batch.column(0)
                found = list(matches(block, [normal_bytes(t.as_py()) for t in batch.column(1)], similarity, repeats))
                near = [1 - e / len(block.words[i]) for _, i, e, _, _ in found]
                columns = [
                    keys.take(pa.array([d for d, *_ in found], pa.int64())),
                    pa.array([block.ids[i] for _, i, *_ in found], item_arrow),
                    [e for _, _, e, _, _ in found], near, [a for *_, a, _ in found], [b for *_, b in found],
                ]
                arrays = [c if kind is None else pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "edits", "similarity", "start_word", "end_word"])

        return run

    item_arrow = items.limit(0).toArrow().schema.field("item_id").type
    out = None
    for part in _blocks(items, block_items):
        block = prepare([r["item_id"] for r in part], [r["text"] for r in part], similarity, repeats)
        found = rows.mapInArrow(search(documents.sparkSession.sparkContext.broadcast(pickle.dumps(tuple(block)))), schema)
        out = found if out is None else out.unionByName(found)
    return documents.sparkSession.createDataFrame([], schema) if out is None else out


def _blocks(items: DataFrame, size: int) -> Iterator[list]:
    part: list = []
    for row in items.toLocalIterator():
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, repeats: int = REPEATS,
    item_key: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The documents, with their own columns, that hold no item of the benchmark. Each row is judged by its own text, inside the scan, so null
    and repeated keys are judged like others. Large benchmarks are one filter for each block of items."""

    def without(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block: Block = Block(*pickle.loads(shared.value))
            for batch in batches:
                hit = {d for d, *_ in matches(block, [normal_bytes(t.as_py()) for t in batch.column(place)], similarity, repeats)}
                yield batch.filter(pa.array([d not in hit for d in range(batch.num_rows)], pa.bool_()))

        return run

    place, out = documents.columns.index(text), documents
    items = benchmark.select(F.col(f"`{item_key}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    for part in _blocks(items, block_items):
        block = prepare([r["item_id"] for r in part], [r["text"] for r in part], similarity, repeats)
        out = out.mapInArrow(without(documents.sparkSession.sparkContext.broadcast(pickle.dumps(tuple(block)))), documents.schema)
    return out
