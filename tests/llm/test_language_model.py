"""Kneser-Ney scores against a brute-force model in plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from netsieve.llm import ngrams


def learned(key):
    return key is None or zlib.crc32(str(key).encode()) % 7 != 2


def brute_scores(rows):
    """{(key, text): (n, known, N, base, score)}; every sum is taken from the definition."""
    split = [(k, t, (t or "").encode("utf-8", "surrogatepass").lower().split()) for k, t in rows]
    pairs, single = Counter(), Counter()
    for k, _, words in split:
        if learned(k):
            single.update([*words, "</s>"])
            pairs.update(zip(["<s>", *words], [*words, "</s>"], strict=True))
    starts = sum(learned(k) for k, _, _ in split)
    total, distinct = sum(single.values()), len(single)
    befores = Counter(w for _, w in pairs)
    follow = defaultdict(Counter)
    for (v, _), c in pairs.items():
        follow[v][min(c, 3)] += 1

    def law(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if min(n) > 0:
            y = n[0] / (n[0] + 2 * n[1])
            found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
            if all(0 < f < k for k, f in enumerate(found, 1)):
                return [0, *found]
        return [0, 0.5, 1.0, 1.5]

    d, e = law(pairs.values()), law(befores.values())
    kinds = sum(befores.values())
    spare = sum(e[min(k, 3)] for k in befores.values()) / max(1, kinds)

    def p1(w):
        if not kinds:
            return 1 / (distinct + 1)
        return (befores[w] - e[min(befores[w], 3)]) / kinds + spare / (distinct + 1)

    def p2(v, w):
        n = starts if v == "<s>" else single[v]
        if not n:
            return p1(w)
        c = pairs[(v, w)]
        return (c - d[min(c, 3)]) / n + sum(d[k] * m for k, m in follow[v].items()) / n * p1(w)

    out = []
    for k, t, words in split:
        seq = [*words, "</s>"]
        base = sum(math.log10((single[w] + 1) / (total + distinct + 1)) for w in seq)
        score = sum(math.log10(p2(v, w)) for v, w in zip(["<s>", *words], seq, strict=True))
        out.append(((k, t), (not learned(k), len(seq), sum(single[w] > 0 for w in seq), total, base, score)))
    assert not rows or not kinds or abs(sum(p1(w) for w in single) + p1("never seen") - 1) < 1e-9
    return out


def check(frame, **options):
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    expected = sorted(((k, *v) for (k, _), v in brute_scores(rows)), key=repr)
    found = ngrams.language_scores(frame, **options).drop("perplexity").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[5], 6), round(r[6], 6))
    expected, found = sorted(expected, key=key), sorted((tuple(r) for r in found), key=key)
    assert len(expected) == len(found)
    for a, b in zip(expected, found, strict=True):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:], b[5:], rtol=1e-9, atol=1e-9), (a, b)


def test_scores_are_those_of_the_definition(odd, documents):
    check(odd)
    check(documents, word_bytes=20_000, pair_tokens=1500)  # many buckets, and words that have several
    check(documents)


def test_ordinary_numbers_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "CHUNK_TOKENS", 3)
    check(spark.createDataFrame([(i, "a b a b a c " * (i % 3) + "d") for i in range(9)], "doc_id long, text string"))


def test_empty_and_unlearned_tables(spark, empty):
    assert ngrams.language_scores(empty).count() == 0
    out = next(i for i in range(100) if not learned(i))
    check(spark.createDataFrame([(out, "a b"), (out, None)], "doc_id long, text string"))
    check(spark.createDataFrame([("k1", "A b"), ("k2", "a c")], "doc_id string, text string"))


def test_held_out_texts_are_likelier_than_under_single_words(documents):
    held = [r for r in ngrams.language_scores(documents).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.perplexity > 1 for r in held)
