"""SimHash near-duplicates: fingerprints of word shingles, bit-sliced comparison in buckets, components of links.

Two fingerprints of 64 bits that differ in at most two bits agree on at least two of four blocks of 16 bits. So each
distinct fingerprint goes to six buckets, one for each pair of blocks, and no link is missed. In a bucket the fingerprints are stored
as 64 vertical bit planes; a plane XORed with a query's bit gives one bit of the distance to 64 fingerprints
at once, a carry-save counter of two bits adds them up, and a block of comparisons is left as soon as all are beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm.components import components
from netsieve.llm.rows import fresh, row_id, split_by_ids
from netsieve.operators.sizing import checkpoint_table

RADIUS = 2
SHINGLE = 3
SEED = 42
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
QUERIES = 256
SPLIT_BUCKET = 4096
PAIR_BATCH = 1 << 16
HOT_SHARE = 1000  # a fingerprint with more than a row in so many is hot
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of a text's word shingles, as an unsigned number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of unsigned numbers: bit i of plane b is bit b of value i; the last words are filled up with 0."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _lanes(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def near_all(values: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of the numbers that differ in at most ``radius`` (1 to 3) bits, in batches."""
    store = planes(values)
    for start in range(0, len(values), QUERIES):
        rows = np.arange(start, min(start + QUERIES, len(values)))
        first = start // 64
        bits = values[rows]
        ones = np.zeros((len(rows), store.shape[1] - first), np.uint64)
        twos, over = np.zeros_like(ones), np.zeros_like(ones)
        for b in range(64):
            flip = np.where((bits >> np.uint64(b)) & np.uint64(1), ONES, np.uint64(0))
            d = store[b, first:][None, :] ^ flip[:, None]
            carry = ones & d
            ones ^= d
            over |= twos & carry
            twos ^= carry
            if radius < 3:
                over |= twos & ones if radius == 2 else twos
            if b % 8 == 7 and b >= 15:
                live = (over != ONES).any(1)
                if not live.all():
                    rows, bits, ones, twos, over = rows[live], bits[live], ones[live], twos[live], over[live]
                    if not len(rows):
                        break
        if len(rows):
            at, j = np.nonzero(_lanes(~over, len(values) - first * 64))
            i, j = rows[at], j + first * 64
            yield i[i < j], j[i < j]


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Whether a[k] and b[k] differ in at most ``radius`` (1 to 3) bits: the same counter, one lane for each pair."""
    store = planes(a ^ b)
    ones = np.zeros(store.shape[1], np.uint64)
    twos, over = np.zeros_like(ones), np.zeros_like(ones)
    for plane in range(64):
        d = store[plane]
        carry = ones & d
        ones ^= d
        over |= twos & carry
        twos ^= carry
        if radius < 3:
            over |= twos & ones if radius == 2 else twos
    return _lanes(~over, len(a))


def _subkeys(values: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Six keys for each number, from the pairs of ``BLOCKS`` blocks of ``bits``."""
    mask = np.uint64((1 << bits) - 1)
    parts = [(values >> np.uint64(i * bits)) & mask for i in range(BLOCKS)]
    for i, j in combinations(range(BLOCKS), 2):
        yield (parts[i] << np.uint64(bits)) | parts[j]


def bucket_links(values: np.ndarray, rest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Close pairs of one large bucket. Its numbers agree on two blocks; ``rest`` has the other two (32 bits). Beyond ``SPLIT_BUCKET``
    numbers it is split by the same rule on four blocks of 8 bits, which misses nothing either."""
    if len(values) <= SPLIT_BUCKET:
        yield from near_all(values)
        return
    for keys in _subkeys(rest, 8):
        order = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0, True])
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            own = order[lo:hi]
            for i, j in near_all(values[own]) if len(own) > 1 else ():
                yield own[i], own[j]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position that each position reaches over the pairs."""
    label = np.arange(n)
    while True:
        old = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == old).all():
            return label


def star_links(values: np.ndarray, tables: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of sorted whole buckets: each number that is close to another of its bucket, with the root of its group."""
    bounds = np.flatnonzero(np.r_[True, (np.diff(keys) != 0) | (np.diff(tables) != 0), True])
    sizes = np.diff(bounds)
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = np.repeat((sizes > 1) & (sizes <= 64), sizes)
    until = np.repeat(bounds[1:], sizes)
    at = np.flatnonzero(small)
    for shift in range(1, 64):
        at = at[at + shift < until[at]]
        if not len(at):
            break
        for k in range(0, len(at), PAIR_BATCH):
            part = at[k : k + PAIR_BATCH]
            near = part[near_pairs(values[part], values[part + shift])]
            found_i.append(near)
            found_j.append(near + shift)
    for b in np.flatnonzero(sizes > 64):
        lo, hi = bounds[b], bounds[b + 1]
        own = values[lo:hi]
        x, y = list(combinations(range(BLOCKS), 2))[int(tables[lo])]
        u, v = [k for k in range(BLOCKS) if k not in (x, y)]
        mask = np.uint64((1 << BLOCK_BITS) - 1)
        rest = ((own >> np.uint64(u * BLOCK_BITS)) & mask) << np.uint64(BLOCK_BITS) | ((own >> np.uint64(v * BLOCK_BITS)) & mask)
        for i, j in bucket_links(own, rest):
            found_i.append(i + lo)
            found_j.append(j + lo)
    label = _roots(len(values), np.concatenate(found_i), np.concatenate(found_j))
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, *also: str) -> DataFrame:
    """doc_id, further columns of numbers, and fp (the fingerprint's 64 bits as a signed number) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(prints.view(np.int64))], names=["doc_id", *also, "fp"])

    rows = documents.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), *also)
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", *also)]
    return rows.mapInArrow(run, ", ".join([*kinds, "fp long"]))


def close_links(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that connect all that differ in at most two bits; stars, not all pairs."""
    block = lambda i: F.shiftrightunsigned("fp", i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    pairs = list(combinations(range(BLOCKS), 2))
    buckets = F.array(*[F.struct(F.lit(t).alias("table"), (F.shiftleft(block(i), BLOCK_BITS) + block(j)).alias("bucket")) for t, (i, j) in enumerate(pairs)])
    rows = prints.select("fp", F.explode(buckets).alias("b")).select("b.table", "b.bucket", "fp")
    rows = rows.repartition("table", "bucket").sortWithinPartitions("table", "bucket", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            u, v = star_links(part[2].view(np.uint64), part[0], part[1])
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        left = None
        for batch in batches:
            now = tuple(np.asarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns)
            now = now if left is None else tuple(np.concatenate(p) for p in zip(left, now, strict=True))
            if not len(now[0]):
                continue
            last = np.flatnonzero((now[0] == now[0][-1]) & (now[1] == now[1][-1]))[0]  # its bucket may go on in the next batch
            if last:
                yield links(tuple(c[:last] for c in now))
            left = tuple(c[last:] for c in now)
        if left is not None:
            yield links(left)

    return rows.mapInArrow(run, "u long, v long")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest key among all that links of at most two bits reach.

    Texts are read once; fingerprints and keys are written to the shared folder. Equal fingerprints are one node,
    so copies cost nothing in buckets and links. Cases: null or empty texts and texts without words have
    fingerprint 0 and are linked like others; null keys stay and do not count as the smallest; repeated rows stay; empty table: no rows.
    """
    prints = checkpoint_table(fingerprints(documents, key, text, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = components(close_links(nodes.select("fp")))
    group = nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = group.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = group.join(smallest, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def group_roots(prints: DataFrame) -> DataFrame:
    """Fingerprints (fp, repeats allowed) -> fp, root: the fingerprint that stands for all that links reach."""
    nodes = checkpoint_table(prints.select("fp").distinct(), "prints")
    linked = components(close_links(nodes))
    return nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents with their own columns, of each group of near copies one row: the smallest key (null last), of equal keys the text with the smallest hash,
    of rows equal in key and text one.

    Rows are judged, not keys: each is known by a hash of key and text, and groups name the ids that go. Texts stay where they are; only rows
    that are repeated as a whole are aggregated. Cases: null, empty and wordless texts are one group (fingerprint 0), of which one row stays; null and
    repeated keys are compared like others; very long texts count whole; empty table: no rows; columns keep their names, whatever they are.
    """
    own = fresh(documents.columns, "_row")
    first, second = f"{own}1", f"{own}2"
    known = documents.withColumns(dict(zip((first, second), row_id(F.col(f"`{key}`"), F.col(f"`{text}`")), strict=True)))
    rows = known.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(first).alias("id1"), F.col(second).alias("id2"))
    prints = checkpoint_table(fingerprints(rows, "doc_id", "text", shingle, "id1", "id2"), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id1", "id2")
    ids = prints.groupBy("fp", "doc_id", "id1", "id2").agg(F.count(F.lit(1)).alias("n"))
    ids = checkpoint_table(ids, "row-ids")
    best = ids.groupBy("fp").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    best = group_roots(best).join(best, "fp")
    chosen = best.groupBy("root").agg(F.min("best").alias("chosen"), F.sum("n").alias("members"))
    chosen = checkpoint_table(best.join(chosen, "root").filter("members > 1").select("fp", "chosen.id1", "chosen.id2", "n"), "chosen-rows")
    hot = ids.count() // HOT_SHARE
    # prints of a large share of rows meet their few choices by broadcast: at most HOT_SHARE of them
    pick = chosen.select(F.col("fp").alias("cfp"), F.col("id1").alias("c1"), F.col("id2").alias("c2"), "n")
    meets = (F.col("fp") == F.col("cfp")) & ~((F.col("id1") == F.col("c1")) & (F.col("id2") == F.col("c2")))
    few, many = F.broadcast(pick.filter(F.col("n") > hot)), pick.filter(F.col("n") <= hot)
    gone = ids.join(few, meets, "left_semi").unionByName(ids.join(many, meets, "left_semi")).select(F.col("id1").alias(first), F.col("id2").alias(second)).distinct()
    again = ids.filter("n > 1").select(F.col("id1").alias(first), F.col("id2").alias(second)).distinct()
    _, kept = split_by_ids(known, first, second, checkpoint_table(gone, "gone-rows"))
    repeated, single = split_by_ids(kept, first, second, checkpoint_table(again, "repeated-rows"))
    return single.unionByName(repeated.dropDuplicates([first, second])).select(*[F.col(f"`{c}`") for c in documents.columns])
