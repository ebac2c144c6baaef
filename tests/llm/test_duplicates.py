"""SimHash, repeated phrases and repeated substrings against brute force."""

import hashlib
from collections import Counter

import numpy as np
import xxhash
from conftest import odd_rows

from netsieve.llm import components, parsing, phrases, simhash


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[tuple]) -> dict:
    """Fingerprint -> smallest key that links of at most two bits reach."""
    values = sorted({p for _, p in prints})
    group = {v: v for v in values}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                group[find(a)] = find(b)
    smallest: dict = {}
    for key, p in prints:
        if key is not None:
            root = find(p)
            smallest[root] = min(smallest.get(root, key), key)
    return {v: smallest.get(find(v)) for v in values}


def test_near_duplicates(odd, documents, empty):
    for frame in (odd, documents):
        prints = [(r.doc_id, brute_fingerprint(r.text)) for r in frame.select("doc_id", "text").collect()]
        ids = brute_components(prints)
        got = Counter(tuple(r) for r in simhash.near_duplicates(frame).collect())
        assert got == Counter((k, f"{p:016x}", ids[p]) for k, p in prints)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_keeps_columns(documents):
    out = simhash.one_of_each(documents)
    assert out.columns == documents.columns
    firsts = {r.doc_id for r in simhash.near_duplicates(documents).collect() if r.doc_id == r.component_id}
    assert sorted(r.doc_id for r in out.collect()) == sorted(firsts)


def check_one_of_each(frame, rows, **options):
    """Of each group one row stays: one with the smallest key, null last."""
    prints = [brute_fingerprint(t) for _, t in rows]
    link = {p: p for p in prints}
    for a in link:
        for b in link:
            if (a ^ b).bit_count() <= 2:
                ra, rb = a, b
                while link[ra] != ra:
                    ra = link[ra]
                while link[rb] != rb:
                    rb = link[rb]
                link[max(ra, rb)] = min(ra, rb)

    def root(p):
        while link[p] != p:
            p = link[p]
        return p

    groups = {}
    for (i, t), p in zip(rows, prints, strict=True):
        groups.setdefault(root(p), []).append((i is None, i or 0, i, t))
    out = [(r.doc_id, r.text) for r in simhash.one_of_each(frame, **options).collect()]
    assert len(out) == len(groups)
    for i, t in out:
        own = groups.pop(root(brute_fingerprint(t)))
        assert (i is None, i or 0) == min(own)[:2] and (i, t) in [x[2:] for x in own]


def test_one_of_each_of_odd_rows(odd, empty, spark, monkeypatch):
    check_one_of_each(odd, [(i, t) for i, t, _ in odd_rows()])
    assert simhash.one_of_each(empty).count() == 0
    same = "the same text that many rows hold, word for word"
    rows = [(None, same)] * 3 + [(5, same), (5, "another text of key five"), (1, same), (1, same), (None, "alone without a key"), (5, None), (None, "")]
    rows += [(k, f"text number {k} of its own {k * k}") for k in range(10, 40)] + [(50, f"text number {k} of its own {k * k}") for k in range(10, 20)]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, _row1 int, _kept int, id1 int").repartition(4)
    check_one_of_each(frame, rows)
    assert simhash.one_of_each(frame).columns == frame.columns
    monkeypatch.setattr("netsieve.llm.rows.LISTED_ROWS", 0)
    monkeypatch.setattr(simhash, "HOT_SHARE", 1 << 40)
    check_one_of_each(frame, rows)


def test_one_of_each_moves_no_text(spark, documents):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = simhash.one_of_each(documents.dropDuplicates(["doc_id"]).filter("text IS NOT NULL"))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("strategy=broadcast") == plan.count("Join "), plan


def near_numbers(n: int, flips: int, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, max(1, n // 4), dtype=np.uint64)
    out = list(base)
    while len(out) < n:
        x = base[rng.integers(len(base))]
        for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
            x ^= np.uint64(1) << np.uint64(b)
        out.append(x)
    return np.unique(np.array(out, np.uint64))


def test_bit_sliced_comparison():
    values = near_numbers(700, 4)
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    for radius in (1, 2, 3):
        want = {(i, j) for i, j in zip(*np.nonzero(distance <= radius), strict=True) if i < j}
        got = {(int(i), int(j)) for a, b in simhash.near_all(values, radius) for i, j in zip(a, b, strict=True)}
        assert got == want
        i, j = np.triu_indices(len(values), 1)
        assert (simhash.near_pairs(values[i], values[j], radius) == (distance[i, j] <= radius)).all()


def test_large_buckets_lose_no_link(monkeypatch):
    low = near_numbers(900, 3, 1) & np.uint64(0xFFFFFFFF)
    values = np.unique(low | np.uint64(0xABCD123400000000))
    monkeypatch.setattr(simhash, "SPLIT_BUCKET", 100)
    got = {(min(i, j), max(i, j)) for a, b in simhash.bucket_links(values, values & np.uint64(0xFFFFFFFF)) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    assert got == {(i, j) for i, j in zip(*np.nonzero(distance <= 2), strict=True) if i < j}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def brute_phrases(rows, window=35):
    split = [(k, (t or "").encode().split()) for k, t in rows]
    counts = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = Counter()
    for k, w in split:
        gone = {i + j for i in range(len(w) - window + 1) if counts[tuple(w[i : i + window])] > 1 for j in range(window)}
        out[(k, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())] += 1
    return out


def test_repeated_phrases(odd, documents, empty):
    for frame, size in ((odd, 20_000), (documents, 60_000)):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        got = Counter(tuple(r) for r in phrases.repeated_phrases(frame, with_text=False, shard_bytes=size).collect())
        assert got == brute_phrases(rows)
    assert phrases.repeated_phrases(empty).count() == 0


def test_phrases_return_what_stays(odd):
    for r in phrases.repeated_phrases(odd).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 and len(r.kept.encode().split()) == r.n_words - r.n_removed


def brute_substrings(rows, window=50):
    first: dict[bytes, int] = {}
    order = [(-(2**63) if k is None else k, k, (t or "").encode()) for k, t in rows]
    for number, _, b in sorted(order, key=lambda r: r[0]):
        for i in range(len(b) - window + 1):
            first.setdefault(b[i : i + window], number)
    out = Counter()
    for number, k, b in order:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] < number:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[(k, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())] += 1
    return out


def test_repeated_substrings(odd, documents, empty):
    for frame, size in ((odd, 20_000), (documents, 60_000)):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        got = Counter(tuple(r) for r in parsing.repeated_substrings(frame, with_text=False, shard_bytes=size).collect())
        assert got == brute_substrings(rows)
    assert parsing.repeated_substrings(empty).count() == 0


def test_repetitive_texts(spark):
    rng = np.random.default_rng(3)
    texts = ["".join("ab"[b] for b in rng.integers(0, 2, 120)) for _ in range(6)]
    texts += [texts[0][10:90] + texts[1][5:80], "ab" * 100, "ab" * 70, texts[2] + texts[2], "a" * 300, "a" * 49, "a" * 50]
    rows = list(enumerate(texts)) + [(3, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in parsing.repeated_substrings(frame, with_text=False, shard_bytes=300).collect())
    assert got == brute_substrings(rows)
    spaced = [(k, " ".join(t)) for k, t in rows]
    frame = spark.createDataFrame(spaced, "doc_id long, text string")
    got = Counter(tuple(r) for r in phrases.repeated_phrases(frame, with_text=False, shard_bytes=300).collect())
    assert got == brute_phrases(spaced)


def test_corpus_order_is_the_suffix_order():
    rng = np.random.default_rng(1)
    for trial in range(30):
        strings = [bytes(rng.integers(97, 99 if trial % 2 else 120, rng.integers(0, 200)).astype(np.uint8)) for _ in range(8)]
        strings += strings[:2]
        data, bounds = np.frombuffer(b"".join(strings), np.uint8), np.r_[0, np.cumsum([len(s) for s in strings])]
        if not len(data):
            continue
        order = parsing.corpus_order(data, bounds)
        owner = np.searchsorted(bounds, order, side="right") - 1
        suffixes = [data[x : bounds[s + 1]].tobytes() for x, s in zip(order, owner, strict=True)]
        assert suffixes == sorted(suffixes) and len(set(order.tolist())) == len(data)


def test_odd_rows_reach_all_cases():
    assert any(t is None for _, t, _ in odd_rows()) and any(k is None for k, *_ in odd_rows())
