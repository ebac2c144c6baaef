"""Decontamination, toxicity and the pipeline."""

import math
import random
import zlib
from collections import Counter

import __spark_entry__
import corpus_pipeline
import numpy as np
from conftest import odd_rows
from pyspark.sql import functions as F
from test_sharding_mixing import brute_mix

from netsieve.llm import decontaminate, mixing, ngrams, quality, simhash, toxicity
from netsieve.llm.words import normal_bytes


def free_ends(item, text):
    """Least edits between the item and any stretch of the text, by the full table."""
    last = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        row = [i + 1]
        for j, b in enumerate(text):
            row.append(min(last[j] + (a != b), last[j + 1] + 1, row[j] + 1))
        last = row
    return min(last)


def test_edit_search():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 80))]
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 90))]
        assert decontaminate.edit_search(item, text)[0] == free_ends(item, text)


def edited(words, edits, rng):
    out = list(words)
    for at in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.random()
        if kind < 0.6:
            out[at] = f"new{rng.randrange(1000)}"
        elif kind < 0.8:
            del out[at]
        else:
            out.insert(at, f"more{rng.randrange(1000)}")
    return out


def test_recall_at_the_limit(spark, small):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()] * 6
    block = decontaminate.prepare(list(range(len(items))), [t for _, t in items])
    rng = random.Random(1)
    for share, least in ((0.0, 1.0), (0.1, 0.97), (0.2, 0.92)):
        texts = []
        for k in range(len(items)):
            words = block.words[k]
            around = [b"fill%d" % rng.randrange(10**6) for _ in range(120)]
            middle = edited([w.decode() for w in words], int(len(words) * share), rng)
            texts.append(b" ".join(around[:60]) + b" " + " ".join(middle).encode() + b" " + b" ".join(around[60:]))
        found = {(d, block.words[i] == block.words[d]) for d, i, *_ in decontaminate.matches(block, texts, 0.8, decontaminate.REPEATS)}
        assert sum((d, True) in found for d in range(len(items))) >= least * len(items)


def test_recall_of_items_of_different_length(spark):
    rng = random.Random(11)
    items = [[f"w{rng.randrange(20_000)}" for _ in range(n)] for n in (15, 40, 80, 160, 400) for _ in range(20)]
    block = decontaminate.prepare(list(range(len(items))), [" ".join(w) for w in items])
    texts = []
    for words in items:
        around = [f"fill{rng.randrange(10**6)}" for _ in range(120)]
        texts.append(" ".join(around[:60] + edited(words, len(words) // 5, rng) + around[60:]).encode())
    found = {(d, i) for d, i, *_ in decontaminate.matches(block, texts, 0.8, decontaminate.REPEATS)}
    for first in range(0, len(items), 20):
        assert sum((k, k) in found for k in range(first, first + 20)) >= 18


def test_contamination_against_brute_force(spark, documents, small):
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    items = [(r.item_id, normal_bytes(r.text).split()) for r in benchmark.collect()]
    want = {}
    for r in documents.collect():
        words = normal_bytes(r.text).split()
        grams = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        for item_id, item in items:
            if any(tuple(item[i : i + 3]) in grams for i in range(len(item) - 2)):
                edits = free_ends(item, words)
                if edits <= 0.2 * len(item):
                    want[(r.doc_id, item_id)] = edits
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contamination(documents, benchmark).collect()}
    assert got == want and want
    blocks = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contamination(documents, benchmark, block_items=7).collect()}
    assert blocks == want


def test_contamination_of_odd_rows(odd, empty, spark):
    passage = odd_rows()[6][1]
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "word"), (None, passage)], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contamination(odd, items).filter("edits = 0").collect())
    holders = [i for i, t, _ in odd_rows() if t and passage.lower() in t.lower()]
    assert got == Counter([(i, j) for i in holders for j in (1, None)] + [(3, 4)])
    kept = decontaminate.clean_documents(odd, items)
    assert kept.columns == odd.columns and not any(r.text and passage in r.text and r.doc_id is not None for r in kept.collect())
    assert decontaminate.contamination(empty, items).count() == 0 and decontaminate.contamination(odd, items.limit(0)).count() == 0


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.toxicity(documents, labels).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    hits = Counter((truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth)
    assert hits[1, 1] >= 0.7 * (hits[1, 0] + hits[1, 1]) and hits[0, 1] <= 0.05 * (hits[0, 0] + hits[0, 1])


def test_labels_that_are_held_out_change_nothing(spark, documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 200)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    other = spark.createDataFrame([(i, (i % 2) ^ (zlib.crc32(str(i).encode()) % 3 == 1)) for i in range(200)], "doc_id long, toxic int")
    a = {r.doc_id: r.score for r in toxicity.toxicity(documents, labels).collect()}
    assert a == {r.doc_id: r.score for r in toxicity.toxicity(documents, other).collect()}


def test_rows_without_a_key_of_their_own_are_judged_by_their_text(spark):
    item = " ".join(f"item{k}" for k in range(30))
    rows = [(None, f"before {item} after"), (None, "nothing to see"), (5, item), (5, "other text of this key"), (6, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontaminate.clean_documents(frame, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert Counter(tuple(r) for r in kept.collect()) == Counter([rows[1], rows[3], rows[4]])
    assert decontaminate.clean_documents(frame, spark.createDataFrame([], "item_id long, text string")).count() == len(rows)


def test_counts_come_from_all_labelled_documents(spark):
    rows = [(i, f"word{i} and then{i % 7} some more") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    fitted = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels, max_train=10)
    tokens = [ngrams.Model(f).sums()["tokens"] for f in fitted.folders]
    learned = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _ in rows)
    assert 6 * (learned - 20) <= sum(tokens) <= 6 * learned


def brute_evidence(train, texts, cap, frequent, head):
    """Evidence of every word by the formulas of the module, from plain counts. ``train`` holds (words, toxic)."""
    counts = Counter(w for words, _ in train for w in words)

    def spell(words):
        return [w if counts[w] >= frequent else b"\0" + w[:head] for w in words]

    def laws(docs):
        pairs = Counter(p for w in docs for p in zip(["<s>", *w], [*w, "</s>"], strict=True))
        n, k = Counter(), Counter(w for _, w in pairs)
        for (v, _), c in pairs.items():
            n[v] += c
        return pairs, n, k

    split = [(spell(w), y) for w, y in train]
    toxic, ordinary = laws([w for w, y in split if y]), laws([w for w, y in split if not y])
    totals = sum(len(pairs) + len(k) for pairs, _, k in (toxic, ordinary)) + 1

    def of_class(model, v, w):
        pairs, n, k = model
        total = sum(k.values())
        shared = (toxic[2][w] + ordinary[2][w] + 1) / totals
        back = (k[w] - min(k[w], cap)) / total + sum(min(c, cap) for c in k.values()) / total * shared
        if not n[v]:
            return back
        c = pairs[v, w]
        return (c - min(c, cap)) / n[v] + sum(min(x, cap) for (a, _), x in pairs.items() if a == v) / n[v] * back

    return [[math.log(of_class(toxic, v, w)) - math.log(of_class(ordinary, v, w)) for v, w in zip(["<s>", *t][:-1], t, strict=True)] for t in map(spell, texts)]


def test_evidence_is_that_of_the_formulas(spark, documents):
    rows = [(r.doc_id, " ".join((r.text or "").split()[:120])) for r in documents.orderBy("doc_id").limit(50).collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 % 2) for i, _ in rows], "doc_id long, toxic int")
    fitted = toxicity.fit(frame, labels, max_train=0, frequent=3, head=4)
    plain = [(i, (t or "").encode()) for i, t in frame.select("doc_id", toxicity.plain_words(F.col("text"))).collect()]
    train = [(t.split(), i % 3 % 2) for i, t in plain if zlib.crc32(str(i).encode()) % 3 != 1]
    models = [(ngrams.Model(f), ngrams.Model(f).sums()) for f in fitted.folders]
    for cap, got in zip((2, 4), toxicity.word_evidence(models, [t for _, t in plain], (2, 4), fitted.spelling)[0], strict=True):
        want = np.concatenate(brute_evidence(train, [t.split() for _, t in plain], cap, 3, 4))
        assert len(want) == len(got) > 1000 and np.allclose(want, got, rtol=1e-9, atol=1e-9)


def test_labels_go_to_the_texts(spark, documents, monkeypatch):
    keys = documents.select(F.col("doc_id").alias("train_key"), F.lit(1).alias("toxic"), F.lit(False).alias("aside")).filter("train_key % 5 = 0")
    keys = toxicity.checkpoint_table(keys, "keys")
    found = toxicity.labelled(documents, keys, "doc_id", "text")
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    want = Counter(map(tuple, found.collect()))
    monkeypatch.setattr("netsieve.llm.rows.LISTED_ROWS", 0)
    assert Counter(map(tuple, toxicity.labelled(documents, keys, "doc_id", "text").collect())) == want and want


def test_toxicity_of_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0.5 for r in toxicity.toxicity(odd, labels.limit(0)).collect())
    assert toxicity.toxicity(empty, labels).count() == 0


def test_pipeline_against_its_parts(spark, small, documents):
    rows = {r.doc_id: (r.text, r.source) for r in documents.collect()}
    kept = {i: v for i, v in rows.items() if quality.judge(v[0])[6]}
    frame = spark.createDataFrame([(i, *v) for i, v in kept.items()], "doc_id long, text string, source string")
    firsts = {r.doc_id for r in simhash.near_duplicates(frame).collect() if r.doc_id == r.component_id}
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.contamination(frame, benchmark).collect()}
    clean = [(i, *kept[i]) for i in firsts - leaks]
    taken = {}
    for (i, size, _, _, words), _ in brute_mix(clean).items():
        if words:
            taken[i] = -(-words // size)
    got = corpus_pipeline.run(spark, small).collect()
    assert Counter(r.doc_id for r in got) == Counter(taken)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mix_sources", "shard"]
    assert mixing.SHARE == 1.5


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n[:2] == "op"} == {f"op{i}" for i in range(1, 14)}
    assert set(__spark_entry__.oracle_sql()) <= set(names)
