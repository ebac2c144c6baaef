"""Substring dedup by repeated-phrase automata over words.

1. Confirm recurring passages: windows of 35 words are counted exactly over the corpus, after anchors have ruled out nearly all.
2. Compile: each shard of documents gets an Aho-Corasick automaton of the confirmed phrases that its documents hold. A stretch of confirmed
   windows gives only the windows that tile it, so an automaton has about as many nodes as there are covered words. A word is one letter.
3. Stream all documents of the shard through its automaton; every occurrence it finds covers 35 words.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import recurrence as R

WINDOW = 35
GRAM = 8
ANCHORS, WINDOWS = 1, 2


class ShardWords:
    """Anchors and windows of a shard's documents; a pure function of the documents, so that each stage gets the same."""

    def __init__(self, docs: R.Table, window: int, gram: int):
        self.docs, self.window, self.gram = docs, window, gram

    def parts(self):
        for first, last, data, bounds in R.pieces(self.docs.texts):
            words, start, end = R.word_symbols(data)
            edges = np.searchsorted(start, bounds)
            sums = R.Sums.of(words)
            yield first, last, start, end, edges, bounds, sums, R.runs(sums, edges, self.window, self.gram)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors and whether they occur twice."""
        found = [p[-1].anchor for p in self.parts()]
        ranked, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        return ranked, counts > 1

    def candidates(self, ranked: np.ndarray, recurs: np.ndarray):
        """For each part, first words and hashes of the windows whose anchors recur."""
        for part in self.parts():
            sums, run = part[-2:]
            live = recurs[R.member(run.anchor, ranked)] if len(run.anchor) else np.zeros(0, bool)
            start, count = run.start[live], run.count[live]
            at = np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(start) else np.zeros(0, np.int64)
            yield part, at, sums.stretches(at, at + self.window)

    def windows(self, ranked: np.ndarray, recurs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [h for _, _, h in self.candidates(ranked, recurs)]
        hashes, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        return hashes, counts > 1


def tiles(starts: np.ndarray, window: int) -> list[int]:
    """Of sorted first words of confirmed windows, those that together cover the same words: every ``window``-th of a stretch and its last."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > 1)
    out: list[int] = []
    for a, b in zip(np.r_[starts[0], starts[cuts + 1]], np.r_[starts[cuts], starts[-1]], strict=True):
        out.extend(range(int(a), int(b), window))
        out.append(int(b))
    return out


def compile_automaton(phrases: list[tuple[bytes, ...]]) -> tuple[ahocorasick.Automaton, dict[bytes, str]]:
    """Automaton of word sequences of one length, and the letter of each word that occurs in them."""
    letters: dict[bytes, str] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in phrases:
        for word in phrase:
            if word not in letters:
                code = len(letters) + 1
                letters[word] = chr(code if code < 0xD800 else code + 0x800)
        automaton.add_word("".join([letters[w] for w in phrase]))
    automaton.make_automaton()
    return automaton, letters


def cover(words: list[bytes], automaton: ahocorasick.Automaton, letters: dict[bytes, str]) -> np.ndarray:
    """Which words the automaton's phrases cover; phrases may overlap."""
    change = np.zeros(len(words) + 1, np.int32)
    for end, size in automaton.iter("".join([letters.get(w, "\0") for w in words])):
        change[end + 1 - size] += 1
        change[end + 1] -= 1
    return np.cumsum(change[:-1]) > 0


def repeated_phrases(
    documents: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text", shard_bytes: int = R.SHARD_BYTES, with_text: bool = True
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``with_text``, kept (the words that stay, joined by blanks).

    A word goes if a window of ``window`` words that covers it starts anywhere else in the corpus too, in the same
    document or another; windows are judged on the input. Documents are shuffled once, by a hash of key and text;
    distinct hashes travel packed, 8 bytes each, and answers are bits.
    Cases: null text: no words; a null key is returned as null; repeated rows are documents of their own, so all of them lose
    what they share; empty table: no rows.
    """
    shards = R.shard_count(documents, text, shard_bytes)
    buckets = R.bucket_count(shards)
    rows = R.by_shard(documents, key, text, shards)
    grouped = rows.groupBy("shard")
    named = "bucket int, shard int, hashes binary, many binary"

    def name_anchors(table: pa.Table) -> pa.Table:
        ranked, many = ShardWords(R.shard_documents(table), window, gram).anchors()
        return R.packed(table.column("shard")[0].as_py(), buckets, ranked, many=many.astype(np.uint8))

    def name_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return R.packed(0, buckets, np.zeros(0, np.uint64), many=np.zeros(0, np.uint8))
        shard = ShardWords(R.shard_documents(table), window, gram)
        ranked, _ = shard.anchors()
        hashes, many = shard.windows(ranked, R.answered(replies, ANCHORS, ranked, buckets))
        return R.packed(table.column("shard")[0].as_py(), buckets, hashes, many=many.astype(np.uint8))

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        docs = R.shard_documents(table) if len(table) else R.Table(np.zeros(0, np.int64), [])
        shard = ShardWords(docs, window, gram)
        ranked, _ = shard.anchors()
        recurs = R.answered(replies, ANCHORS, ranked, buckets)
        hashes, _ = shard.windows(ranked, recurs)
        confirmed = R.answered(replies, WINDOWS, hashes, buckets)
        phrases: set[tuple[bytes, ...]] = set()
        for (first, last, _, _, edges, _, _, _), at, found in shard.candidates(ranked, recurs):
            at = np.sort(at[confirmed[R.member(found, hashes)]]) if len(at) else at
            owner = np.searchsorted(edges, at, side="right") - 1
            for d in np.unique(owner):
                words = docs.texts[first + d].split()
                for start in tiles(at[owner == d] - edges[d], window):
                    phrases.add(tuple(words[start : start + window]))
        automaton, letters = compile_automaton(sorted(phrases)) if phrases else (None, {})
        for key_value, body in zip(docs.ids.tolist(), docs.texts, strict=True):
            words = body.split()
            kept = words
            if automaton is not None and len(words) >= window:
                gone = cover(words, automaton, letters)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            line = b" ".join(kept)
            out["doc_id"].append(key_value)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(hashlib.sha256(line).hexdigest())
            out["kept"].append(line.decode("utf-8", "replace") if with_text else None)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds, strict=True)})

    anchors = grouped.applyInArrow(name_anchors, named)
    level1 = anchors.groupBy("bucket").applyInArrow(R.recurring(ANCHORS), R.ANSWER)
    windows = grouped.cogroup(level1.groupBy("shard")).applyInArrow(name_windows, named)
    level2 = windows.groupBy("bucket").applyInArrow(R.recurring(WINDOWS), R.ANSWER)
    replies = level1.unionByName(level2)
    result = grouped.cogroup(replies.groupBy("shard")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    result = result if with_text else result.drop("kept")
    return result.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(2**63)).cast("long"), F.col("doc_id")))
