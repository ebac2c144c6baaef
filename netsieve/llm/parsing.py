"""Substring dedup of bytes by prefix-free parsing and suffix arrays.

Which stretches of text need sorting at all is found first, on hashes: windows of 50 bytes are grouped into runs with a common
anchor (see recurrence). A run that an earlier document holds in full needs no order. Only runs that occur in more than one form are
sent, each form once from its first document, to the bucket of their anchor, where equal windows meet.

There the texts are parsed: a rolling hash of ``TRIGGER`` bytes cuts them into phrases that overlap by the trigger, so that no proper
suffix of a phrase longer than the trigger is the prefix of another. Distinct phrases form the dictionary; the parse is the sequence of
their ranks. The suffix array of the dictionary and that of the parse give the order of all positions of the texts: first by the rest of
their phrase, then by what follows in the parse. Neighbours in this order that share 50 bytes form a class, and a window is repeated if its
class holds a smaller document.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import recurrence as R

WINDOW = 50
GRAM = 20
TRIGGER = 4
MODULUS = 11
SHARD_BYTES = R.SHARD_BYTES // 2  # runs of bytes are far more than runs of words
SORT_BYTES = 1 << 18
ANCHORS, EARLIER, FORMS, SORTED = 1, 2, 3, 4


def suffix_ranks(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Rank of the suffix from each place to the end of its string (``left`` symbols, itself included), by prefix doubling.
    Equal suffixes have equal ranks, counted from 1; a shorter string comes before its continuations."""
    ranks = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    step, n = 1, len(symbols)
    longest = int(left.max()) if n else 0
    while step < longest:
        follow = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > step)
        follow[inside] = ranks[inside + step]
        ranks = np.unique(ranks * (n + 2) + follow, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return ranks


def phrases(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of the phrases of the strings [bounds[i], bounds[i + 1]). A phrase starts at a string's start or a trigger
    and ends with the next trigger, or at the string's end."""
    hashes = R.Sums.of(R.BYTE_VALUES[data]).grams(TRIGGER)
    at = np.flatnonzero(hashes % np.uint64(MODULUS) == 0)
    string = np.searchsorted(bounds, at, side="right") - 1
    at = at[(at + TRIGGER <= bounds[string + 1]) & (at > bounds[string])]
    start = np.union1d(bounds[:-1][np.diff(bounds) > 0], at)
    stop = bounds[np.searchsorted(bounds, start, side="right")]
    end = np.minimum(np.r_[start[1:] + TRIGGER, len(data)], stop)
    return start, end


def corpus_order(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All positions of the strings in the order of their suffixes (each ends with its string), by prefix-free parsing."""
    start, end = phrases(data, bounds)
    size = end - start
    sums = R.Sums.of(R.BYTE_VALUES[data])
    _, sample, phrase = np.unique(sums.stretches(start, end), return_index=True, return_inverse=True)
    word_start, word_size = start[sample], size[sample]
    offset = np.r_[0, np.cumsum(word_size)]
    inner = np.arange(offset[-1]) - np.repeat(offset[:-1], word_size)
    letters = data[np.repeat(word_start, word_size) + inner]
    dictionary = suffix_ranks(letters, np.repeat(word_size, word_size) - inner)
    # The parse, as ranks of whole phrases, and the rank of what follows each phrase in its string.
    parse = dictionary[offset[:-1]][phrase]
    string = np.searchsorted(bounds, start, side="right") - 1
    last = np.r_[string[1:] != string[:-1], True] if len(string) else np.zeros(0, bool)
    stop = np.flatnonzero(last)
    left = stop[np.searchsorted(stop, np.arange(len(start)))] - np.arange(len(start)) + 1
    parsed = suffix_ranks(parse, left)
    follow = np.where(last, 0, np.r_[parsed[1:], 0])
    # A position belongs to the phrase in which more than the trigger is left, or to the last one of its string.
    own = np.where(last, size, size - TRIGGER)
    owner = np.repeat(np.arange(len(start)), own)
    place = np.arange(len(data)) - start[owner]
    return np.lexsort((follow[owner], dictionary[offset[phrase[owner]] + place]))


def repeated_windows(data: np.ndarray, bounds: np.ndarray, docs: np.ndarray, window: int) -> np.ndarray:
    """For each position: whether the window from there on lies in its string and also in a string of a smaller document."""
    out = np.zeros(len(data), bool)
    if not len(data):
        return out
    order = corpus_order(data, bounds)
    string = np.searchsorted(bounds, order, side="right") - 1
    whole = order + window <= bounds[string + 1]
    order, string = order[whole], string[whole]
    if not len(order):
        return out
    views = np.lib.stride_tricks.sliding_window_view(data, window)
    same = np.zeros(len(order), bool)
    for a in range(1, len(order), 1 << 16):
        b = min(a + (1 << 16), len(order))
        same[a:b] = (views[order[a:b]] == views[order[a - 1 : b - 1]]).all(1)
    first = np.flatnonzero(~same)
    owner = docs[string]
    lowest = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.r_[first, len(order)]))
    out[order] = owner > lowest
    return out


class Found(NamedTuple):
    """Runs of a shard whose anchors recur, sorted by anchor, form and document; ``form`` numbers the distinct (anchor, hash of the run)."""

    anchor: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    part: np.ndarray
    start: np.ndarray
    count: np.ndarray
    form: np.ndarray
    first: np.ndarray  # of each form, its place among the runs


class ShardBytes:
    """Runs of a shard's documents; a pure function of the documents, so that each stage gets the same."""

    def __init__(self, docs: R.Table, window: int, gram: int):
        self.docs, self.window, self.gram = docs, window, gram
        self.parts = list(R.pieces(docs.texts, b""))

    def runs(self):
        for _, _, data, bounds in self.parts:
            sums = R.Sums.of(R.BYTE_VALUES[data])
            yield sums, R.runs(sums, bounds, self.window, self.gram)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors and whether two documents of the shard have them."""
        anchor, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for (first, *_), (_, run) in zip(self.parts, self.runs(), strict=True):
            anchor.append(run.anchor)
            doc.append(self.docs.ids[first + run.doc])
        a, d = np.concatenate(anchor), np.concatenate(doc)
        order = np.argsort(a, kind="stable")  # documents are in order of their keys, so equal anchors are too
        a, d = a[order], d[order]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(a)] - 1 if len(a) else first
        return a[first], d[first] != d[last]

    def found(self, ranked: np.ndarray, recurs: np.ndarray) -> Found:
        columns: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], *[[np.zeros(0, np.int64)] for _ in range(4)]]
        for k, ((first, *_), (sums, run)) in enumerate(zip(self.parts, self.runs(), strict=True)):
            live = recurs[R.member(run.anchor, ranked)] if len(run.anchor) else np.zeros(0, bool)
            start, count = run.start[live], run.count[live]
            row = (run.anchor[live], sums.stretches(start, start + count + self.window - 1), self.docs.ids[first + run.doc[live]], np.full(len(start), k), start, count)
            for column, values in zip(columns, row, strict=True):
                column.append(values)
        a, h, d, part, start, count = (np.concatenate(c) for c in columns)
        order = np.lexsort((d, h, a))
        a, h, d, part, start, count = (c[order] for c in (a, h, d, part, start, count))
        new = np.r_[True, (a[1:] != a[:-1]) | (h[1:] != h[:-1])] if len(a) else np.zeros(0, bool)
        return Found(a, h, d, part, start, count, np.cumsum(new) - 1, np.flatnonzero(new))

    def text(self, found: Found, at: int) -> bytes:
        data, start = self.parts[found.part[at]][2], found.start[at]
        return data[start : start + found.count[at] + self.window - 1].tobytes()


def compare_forms(table: pa.Table) -> pa.Table:
    """For the forms of one bucket: whether an earlier document elsewhere has the same form, and whether the form needs sorting,
    being one of several with its anchor and first in its document."""
    anchor, edges = R.unpacked(table, "hashes", np.uint64)
    form, _ = R.unpacked(table, "forms", np.uint64)
    doc, _ = R.unpacked(table, "docs", np.int64)
    earlier, several = np.zeros(len(anchor), np.uint8), np.zeros(len(anchor), np.uint8)
    if len(anchor):
        order = np.lexsort((doc, form, anchor))
        a, f, d = anchor[order], form[order], doc[order]
        new_anchor = np.r_[True, a[1:] != a[:-1]]
        new_form = new_anchor | np.r_[True, f[1:] != f[:-1]]
        first = np.flatnonzero(new_form)
        earlier[order] = d > np.repeat(d[first], np.diff(np.r_[first, len(a)]))
        first = np.flatnonzero(new_anchor)
        several[order] = np.repeat(np.add.reduceat(new_form.astype(np.int64), first) > 1, np.diff(np.r_[first, len(a)]))
    return pa.concat_tables([R.answers(table, edges, earlier, EARLIER), R.answers(table, edges, several & ~earlier & 1, FORMS)])


def sort_forms(window: int):
    """For the texts of one bucket: which windows also occur in a smaller document. Anchors are taken in order, about ``SORT_BYTES`` at a time."""

    def run(table: pa.Table) -> pa.Table:
        anchor, edges = R.unpacked(table, "hashes", np.uint64)
        doc, _ = R.unpacked(table, "docs", np.int64)
        size, _ = R.unpacked(table, "sizes", np.int64)
        data, _ = R.unpacked(table, "texts", np.uint8)
        start = np.r_[0, np.cumsum(size)]
        bits = np.zeros(len(data), bool)
        order = np.argsort(anchor, kind="stable")
        new = np.flatnonzero(np.r_[True, np.diff(anchor[order]) != 0]) if len(order) else np.zeros(0, np.int64)
        total = np.r_[0, np.cumsum(size[order])]
        group = total[new] // SORT_BYTES
        cuts = np.r_[new[np.flatnonzero(np.r_[True, np.diff(group) > 0])], len(order)] if len(order) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = order[a:b]
            bounds = np.r_[0, np.cumsum(size[own])]
            at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size[own]) + np.repeat(start[own], size[own])
            bits[at] = repeated_windows(data[at], bounds, doc[own], window)
        windows = np.arange(len(data)) < np.repeat(start[1:], size) - window + 1
        counts = np.r_[0, np.cumsum(size - window + 1)][edges]
        return R.answers(table, counts, bits[windows].astype(np.uint8), SORTED)

    return run


def repeated_substrings(
    documents: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES, with_text: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``with_text``, kept (the bytes that stay) of every document.

    A byte goes if a string of ``window`` bytes that covers it also starts in a document with a smaller key; strings are judged on the input.
    Cases: null text: empty; a null key comes before all others and is returned as null; repeated rows have the same key, so none of them is
    earlier than another; empty table: no rows.
    """
    shards = R.shard_count(documents, text, shard_bytes)
    buckets = sorters = R.bucket_count(shards, 2)
    grouped = R.by_shard(documents, key, text, shards).groupBy("shard")

    def opened(table: pa.Table, replies: pa.Table) -> tuple[ShardBytes, Found]:
        shard = ShardBytes(R.shard_documents(table), window, gram)
        ranked, _ = shard.anchors()
        return shard, shard.found(ranked, R.answered(replies, ANCHORS, ranked, buckets))

    def name_anchors(table: pa.Table) -> pa.Table:
        ranked, many = ShardBytes(R.shard_documents(table), window, gram).anchors()
        return R.packed(table.column("shard")[0].as_py(), buckets, ranked, many=many.astype(np.uint8))

    def name_forms(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return R.packed(0, buckets, np.zeros(0, np.uint64), forms=np.zeros(0, np.uint64), docs=np.zeros(0, np.int64))
        _, found = opened(table, replies)
        return R.packed(table.column("shard")[0].as_py(), buckets, found.anchor[found.first], forms=found.hash[found.first], docs=found.doc[found.first])

    def send_forms(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return R.packed(0, sorters, np.zeros(0, np.uint64), docs=np.zeros(0, np.int64), sizes=np.zeros(0, np.int64)).append_column("texts", pa.array([], pa.binary()))
        shard, found = opened(table, replies)
        at = found.first[R.answered(replies, FORMS, found.anchor[found.first], buckets)]
        out = R.packed(table.column("shard")[0].as_py(), sorters, found.anchor[at], docs=found.doc[at], sizes=found.count[at] + window - 1)
        ends = np.cumsum([len(b) // 8 for b in out.column("hashes").to_pylist()]).astype(np.int64)
        texts = [b"".join(shard.text(found, i) for i in at[a:b]) for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)] if len(at) else []
        return out.append_column("texts", pa.array(texts, pa.binary()))

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        if len(table):
            shard, found = opened(table, replies)
            anchors = found.anchor[found.first]
            earlier = R.answered(replies, EARLIER, anchors, buckets)
            forms = np.flatnonzero(R.answered(replies, FORMS, anchors, buckets))
            windows = found.count[found.first[forms]]
            bits = R.answered(replies, SORTED, np.repeat(anchors[forms], windows), sorters)
            whole = (found.doc > found.doc[found.first][found.form]) | earlier[found.form] if len(found.form) else np.zeros(0, bool)
            # Runs of the first document of a form that was sorted: one change at each border between repeated and other windows.
            ends = np.r_[0, np.cumsum(windows)]
            row_of = np.full(len(found.first), -1)
            row_of[forms] = np.arange(len(forms))
            changes = [np.zeros(len(data) + 1, np.int32) for _, _, data, _ in shard.parts]
            for k in range(len(shard.parts)):
                own = np.flatnonzero(whole & (found.part == k))
                np.add.at(changes[k], found.start[own], 1)
                np.add.at(changes[k], found.start[own] + found.count[own] + window - 1, -1)
                own = np.flatnonzero(~whole & (found.part == k))
                own = own[row_of[found.form[own]] >= 0]
                count = found.count[own]
                inner = np.arange(count.sum()) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count) if len(own) else np.zeros(0, np.int64)
                hit = bits[np.repeat(ends[row_of[found.form[own]]], count) + inner] if len(own) else np.zeros(0, bool)
                at = (np.repeat(found.start[own], count) + inner)[hit]
                np.add.at(changes[k], at, 1)
                np.add.at(changes[k], at + window, -1)
            for (first, last, data, bounds), change in zip(shard.parts, changes, strict=True):
                gone = np.cumsum(change[:-1]) > 0
                for i in range(first, last):
                    a, b = bounds[i - first], bounds[i - first + 1]
                    own = gone[a:b]
                    kept = data[a:b][~own].tobytes()
                    out["doc_id"].append(int(shard.docs.ids[i]))
                    out["n_bytes"].append(int(b - a))
                    out["n_removed"].append(int(own.sum()))
                    out["n_spans"].append(int(np.count_nonzero(own[1:] & ~own[:-1]) + (len(own) > 0 and bool(own[0]))))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept if with_text else None)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds, strict=True)})

    named = "bucket int, shard int, hashes binary, "
    anchors = grouped.applyInArrow(name_anchors, named + "many binary")
    level1 = anchors.groupBy("bucket").applyInArrow(R.recurring(ANCHORS), R.ANSWER)
    forms = grouped.cogroup(level1.groupBy("shard")).applyInArrow(name_forms, named + "forms binary, docs binary")
    level2 = forms.groupBy("bucket").applyInArrow(compare_forms, R.ANSWER)
    sent = grouped.cogroup(level1.unionByName(level2).groupBy("shard")).applyInArrow(send_forms, named + "docs binary, sizes binary, texts binary")
    level3 = sent.groupBy("bucket").applyInArrow(sort_forms(window), R.ANSWER)
    replies = level1.unionByName(level2).unionByName(level3)
    result = grouped.cogroup(replies.groupBy("shard")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    result = result if with_text else result.drop("kept")
    return result.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(2**63)).cast("long"), F.col("doc_id")))
