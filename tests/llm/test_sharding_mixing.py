import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import odd_rows

from netsieve.llm import mixing, sharding


def test_placement_of_odd_rows(odd):
    got = sharding.placement(odd).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in odd_rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_even_and_follow_weights(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    even = Counter(r.shard for r in sharding.assign_shards(rows, "doc_id", [1.0] * 4).collect())
    assert min(even.values()) > 4700 and max(even.values()) < 5300
    uneven = Counter(r.shard for r in sharding.assign_shards(rows, "doc_id", [1.0, 3.0, 0.0]).collect())
    assert 2 not in uneven and 2.8 < uneven[1] / uneven[0] < 3.2
    moved = sharding.assign_shards(rows, "doc_id", [1.0] * 4, 1.0).filter("shard != grown_shard").collect()
    assert {r.grown_shard for r in moved} == {4} and 3700 < len(moved) < 4300
    with pytest.raises(ValueError):
        sharding.assign_shards(rows, "doc_id", [0.0])


def water_fill(sizes: dict, weights: dict, share: float, cap: float) -> dict:
    """Deals again and again what is over, as long as some target is above its cap."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    budget = share * sum(sizes.values())
    while open_:
        left = budget - sum(target[s] for s in sizes if s not in open_)
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > cap * sizes[s]}
        for s in over or open_:
            target[s] = cap * sizes[s] if over else left * weights[s] / total
        if not over:
            break
        open_ -= over
    return target


def brute_mix(rows: list[tuple]) -> Counter:
    size = lambda t: len((t or "").encode().split())
    sources = sorted({s for *_, s in rows if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for *_, s in rows)
    sizes = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    target = water_fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}, 1.5, 2)
    out = Counter()
    for s in sources:
        epochs, rest = divmod(int(target[s] + 0.5), sizes[s]) if sizes[s] else (0, 0)
        key = lambda r: (int(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:15], 16), r[0] is not None, r[0] or 0, size(r[1]))
        for i, t, _ in sorted((r for r in rows if r[2] == s), key=key):
            part = max(0, min(size(t), rest))
            rest -= part
            out[(i, size(t), sizes[s], round(target[s], 6), epochs * size(t) + part)] += 1
    return out


def test_mix_against_brute_force(odd, documents):
    for frame in (odd, documents):
        rows = [(r.doc_id, r.text, r.source) for r in frame.select("doc_id", "text", "source").collect()]
        got = Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(frame).collect())
        assert got == brute_mix(rows)


def test_mixed_documents_hold_what_is_taken(documents):
    taken = sum(r.taken for r in mixing.mix(documents).collect())
    out = mixing.mixed_documents(documents)
    assert out.columns == documents.columns
    assert sum(len(r.text.encode().split()) for r in out.collect()) == taken


def test_rows_without_a_key_of_their_own_are_taken_as_the_mix_says(spark):
    rows = [(None, "one", "s0"), (None, " ".join(["long"] * 2000), "s0"), (None, "two words", "s1"), (None, "other words", "s1"), (None, "more words", "s0")]
    rows += [(7, " ".join(f"w{k}" for k in range(n)), s) for n in (3, 40, 41, 300) for s in ("s0", "s1", None)] + [(7, "x y z", "s0")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = Counter()
    for r in mixing.mix(frame).collect():
        want[r.doc_id, r.source] += r.taken
    out, got = mixing.mixed_documents(frame).collect(), Counter()
    for r in out:
        got[r.doc_id, r.source] += len(r.text.split())
    assert +got == +want and len(out) <= 2 * len(rows)


def test_the_mix_moves_no_text_and_keeps_names(spark):
    rows = [(i, f"word {i} " * (i % 9 + 1), f"s{i % 3}", i, "x", "y") for i in range(300)] + [(None, "copy of many", "s0", 1, "x", "y")] * 100
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, _mix_size long, rest string, _kept string")
    out = mixing.mixed_documents(frame, bucket_bits=2)
    assert out.columns == frame.columns
    want, got = Counter(), Counter()
    for r in mixing.mix(frame, bucket_bits=2).collect():
        want[r.doc_id, r.source] += r.taken
    for r in out.collect():
        got[r.doc_id, r.source] += len(r.text.split())
        assert (r._mix_size, r.rest) in {(x[3], x[4]) for x in rows if x[0] == r.doc_id}
    assert +got == +want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan, plan
    for exchange in plan.split("Exchange hashpartitioning")[1:]:
        assert "_epochs" in exchange.split("\n")[0]  # only the one row of each source at which its budget ends


def test_one_row_repeated_by_a_third(spark):
    rows = [(1, "same words here", "a")] * 3000 + [(i, "some other text", "b") for i in range(10, 4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    for share in (0.3, 1.5):
        want = sum(r.taken for r in mixing.mix(frame, share=share).collect())
        assert sum(len(r.text.split()) for r in mixing.mixed_documents(frame, share=share).collect()) == want


def test_empty_tables(empty):
    assert sharding.placement(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0
