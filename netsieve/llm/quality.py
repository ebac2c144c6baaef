"""Line-first cleaning: each line is judged on its own, failing lines go, and a document that loses too much is rejected.

A line fails if
- punctuation: symbol marks or doubled sentence marks hang on at least ``SYMBOL_SHARE`` of its words;
- navigation: separators (bars, arrows, bullets) are at least ``NAVIGATION_SHARE`` of its words;
- repetition: at least ``STUTTER_SHARE`` of its words repeat the word before;
- boilerplate: it is short and holds a phrase of the kind that sites repeat on each page, or an earlier line of the document was equal.
A document is rejected if the failing lines hold more than ``LOST_SHARE`` of its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the rules.
SYMBOL_SHARE = 0.3
NAVIGATION_SHARE = 0.2
STUTTER_SHARE = 0.5
BOILERPLATE_WORDS = 30
LOST_SHARE = 0.5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
NAVIGATION = {"|", "||", "»", "«", "›", "‹", ">", ">>", "<", "•", "·", "→", "←", "/", "::"}
BOILERPLATE = (
    "all rights reserved", "accept cookies", "use of cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "terms and conditions", "sign up for", "subscribe to", "log in to", "click here", "read more", "share this", "skip to content",
    "enable javascript", "lorem ipsum",
)

_MARKED = re.compile(r"[#*$%&|<>]{2,}|[!?]{2,}")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_PHRASE = re.compile("|".join(re.escape(p) for p in BOILERPLATE), re.IGNORECASE)


def words_of(text: str) -> list[str]:
    """Words as everywhere in this package: only the blank and 0x09 to 0x0D separate."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def line_fails(line: str, words: list[str]) -> bool:
    """The rules for one line with words, repetition apart."""
    n = len(words)
    if sum(1 for w in words if _MARKED.search(w)) >= SYMBOL_SHARE * n:
        return True
    if sum(1 for w in words if w in NAVIGATION) >= NAVIGATION_SHARE * n:
        return True
    if n > 1 and sum(a == b for a, b in zip(words, words[1:], strict=False)) >= STUTTER_SHARE * n:
        return True
    return n <= BOILERPLATE_WORDS and _PHRASE.search(line) is not None


def repeat_words(words: list) -> int:
    """Words in windows of five that occur twice or more in the text, the first occurrence included."""
    if len(words) < 6:
        return 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 5 - max(i, end)
            end = i + 5
    return covered


def judge(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost words, text without failing lines."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    seen: set[bytes] = set()
    dups = lost = 0
    good = []
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            good.append(line)
            continue
        again = line in seen
        seen.add(line)
        dups += again
        if again or line_fails(line.decode("utf-8", "surrogatepass"), [w.decode("utf-8", "surrogatepass") for w in own]):
            lost += len(own)
        else:
            good.append(line)
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    repeated = repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeated > REPEAT_PERCENT * n
    kept = not failed and lost <= LOST_SHARE * n
    symbols = len(_SYMBOL.findall(text))
    return n, chars, symbols, dups, repeated, failed, kept, lost, b"\n".join(good).decode("utf-8", "surrogatepass")


FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(), "kept": pa.bool_(), "n_lost_words": pa.int64(), "clean_text": pa.string(),
}
KINDS = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}


def quality(documents: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Measures and verdict of every document, and with ``with_text`` what its passing lines say (``clean_text``).

    A narrow map over whole texts. Cases: null text: no words, base_failed; repeated rows and null keys stay; empty table: no rows.
    """
    fields = {k: v for k, v in FIELDS.items() if with_text or k != "clean_text"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*[judge(t.as_py()) for t in batch.column(1)], strict=True)) or [()] * len(FIELDS)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, fields.values(), strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *fields])

    rows = documents.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{k} {KINDS[v]}" for k, v in fields.items()))


def passing(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns and their own text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(t.as_py())[6] for t in batch.column(place)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    place = documents.columns.index(text)
    return documents.mapInArrow(run, documents.schema)
