"""Toxicity by two Kneser-Ney bigram models, one of toxic and one of ordinary documents, over backoff counts that both share.

For a class c, a word w after v has
    P_c(w | v) = (n_c(v, w) - min(n_c(v, w), D)) / n_c(v) + g_c(v) * P_c(w)
    P_c(w)     = (k_c(w) - min(k_c(w), D)) / K_c         + g_c    * P(w)
    P(w)       = (k(w) + 1) / (K + V + 1)
with n counts, k_c numbers of different words before w in the class and K_c their sum, g what the discounts left; k, K and the number V of tokens are summed over
both classes, which share P. Every pair counts. A rare expression costs both classes the same but for what one of them has seen of it beyond the discount D, an absolute
one as in the first form of the method, which is not taken from counts of counts but fitted: of ``DISCOUNTS``, the one under which the documents set aside are judged best.

A word's evidence is log P_toxic - log P_ordinary. It is averaged over the document and over each stretch of ``STRETCH`` words (all stretches,
so that a long text with one insult is seen), and a logistic curve on the two turns it into a score.

The two models are those of ``ngrams``: counted in Spark from all labelled documents that are not held out (but those that fit the curve), stored as
sorted arrays in the shared folder and mapped by the workers. Nothing of them passes through the driver or a broadcast. Only the fit of the
logistic curve is bounded: it takes its documents from at most ``MAX_TRAIN`` of each class, chosen by a hash of their keys. Texts stay where
they are: labels go to them, by broadcast up to ``LISTED_ROWS`` keys; beyond, a bit table sets apart the labelled texts, and only those are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve.llm import ngrams, rows
from netsieve.llm.words import PUNCTUATION
from netsieve.operators.sizing import checkpoint_table

MAX_TRAIN = 3000
STRETCH = 6
FREQUENT = 20  # occurrences in the training texts from which a word is a token of its own
HEAD = 5  # bytes by which other words are known
DISCOUNTS = (2, 4, 8, 16, 32, 64)
THRESHOLD = 0.7
CALIBRATION_SHARE = 4  # one of so many documents of the bounded sample is for the logistic curve


def plain_words(text: Column) -> Column:
    """Lower case, without ASCII punctuation; empty for null."""
    return F.translate(F.lower(F.coalesce(text.cast("string"), F.lit(""))), PUNCTUATION.decode(), "")


def summaries(evidence: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each text: the largest mean evidence of a stretch, and the mean over the text. Stretches at the ends are filled up with 0."""
    n = len(edges) - 1
    out = np.zeros((n, 2))
    total = np.r_[0.0, np.cumsum(evidence)]
    for i in range(n):
        a, b = edges[i], edges[i + 1]
        if b > a:
            sums = total[np.minimum(np.arange(a, b) + STRETCH, b)] - total[a:b]
            out[i] = sums.max() / STRETCH, (total[b] - total[a]) / (b - a)
    return out


class Fitted(NamedTuple):
    """Folders of the models (toxic, ordinary), how words are spelled in them, the discount, and the curve (constant, stretch, document)."""

    folders: list[str]
    spelling: ngrams.Spelling
    discount: int
    curve: tuple[float, float, float]


def word_evidence(models: list[tuple[ngrams.Model, dict]], texts: list[bytes], discounts: tuple[int, ...], spelling: ngrams.Spelling | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Evidence of every word of the texts under (toxic, ordinary), one array for each discount, and the edges of texts."""
    sequence, edges = ngrams.tokens(texts, spelling)
    distinct, before, word, pair, first = ngrams.pairs_of(sequence, edges)
    last = np.r_[first[1:], len(pair)] - 1  # the end of each text is no word
    totals = sum(sums["k"] + sums["distinct"] for _, sums in models) + 1
    out = []
    for cap in discounts:
        laws = [ngrams.Law.of(*model, distinct, before, word, cap) for model in models]
        shared = (laws[0].before + laws[1].before + 1) / totals
        logs = [np.log(c.direct + c.back[before] * (c.own + c.spare * shared)[word]) for c in laws]
        out.append(np.delete((logs[0] - logs[1])[pair], last))
    return out, np.r_[first, len(pair)] - np.arange(len(first) + 1)


def evidence(documents: DataFrame, fitted: Fitted, discounts: tuple[int, ...] | None = None) -> DataFrame:
    """doc_id, and stretch and mean under each discount (stretch0, mean0, ...), of rows (doc_id, text) of plain words."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    asked = discounts or (fitted.discount,)
    names = [f"{n}{i}" for i in range(len(asked)) for n in ("stretch", "mean")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [(m, m.sums()) for m in map(ngrams.Model, fitted.folders)]
        for table, texts in ngrams.chunks(batches, 1):
            found, edges = word_evidence(models, texts, asked, fitted.spelling)
            columns = [pa.array(c) for one in found for c in summaries(one, edges).T.copy()]
            yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), *columns], names=["doc_id", *names])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names))


def lost(curve: tuple[float, float, float], x: np.ndarray, y: np.ndarray) -> float:
    """Mean logistic loss, both classes weighing the same."""
    z = np.clip(curve[0] + x @ np.array(curve[1:]), -30, 30)
    loss = np.log1p(np.exp(np.where(y, -z, z)))
    return float(loss[y].mean() + loss[~y].mean())


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float, float]:
    """Weights (constant, stretch, document) of a logistic curve by Newton steps with a small ridge; classes weigh the same."""
    rows = np.c_[np.ones(len(x)), x]
    toxic = max(1.0, float(y.sum()))
    weight = np.where(y, len(y) / (2 * toxic), len(y) / (2 * max(1.0, len(y) - toxic)))
    beta = np.zeros(3)
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (weight * (p - y)) + ridge @ beta
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge
        beta = beta - np.linalg.solve(bend, slope)
    return tuple(float(v) for v in beta)


def held_out(key: Column) -> Column:
    """Documents whose label is never learned: CRC-32 of the key as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def training_keys(labels: DataFrame, key: str, label: str) -> DataFrame:
    """train_key, toxic, place of all keys that are not held out. A key with several labels counts as toxic if one is."""
    rows = labels.select(F.col(f"`{key}`").alias("train_key"), F.col(f"`{label}`").cast("int").alias("toxic"))
    rows = rows.filter(F.col("train_key").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("train_key")))
    return rows.groupBy("train_key").agg(F.max("toxic").alias("toxic")).withColumn("place", F.xxhash64("train_key"))


def curve_keys(keys: DataFrame, max_train: int) -> DataFrame:
    """Keys for the logistic curve: one in ``CALIBRATION_SHARE`` of at most ``max_train`` of each class, lowest hashes first. A bounded table."""
    parts = [keys.filter(cond).orderBy("place", "train_key").limit(max_train) for cond in ("toxic = 1", "toxic <> 1")]
    return parts[0].unionByName(parts[1]).filter(F.pmod("place", F.lit(CALIBRATION_SHARE)) == 0).select("train_key", F.lit(True).alias("aside"))


def labelled(documents: DataFrame, keys: DataFrame, key: str, text: str) -> DataFrame:
    """text (plain words), toxic, aside of the documents whose key is in the stored table ``keys``."""
    found = documents.select(F.col(f"`{key}`").alias("train_key"), F.col(f"`{text}`").alias("text"))
    if keys.count() <= rows.LISTED_ROWS:
        keys = F.broadcast(keys)
    else:
        first, second = rows.row_id(F.col("train_key"))
        ids = checkpoint_table(keys.select(first.alias("id1"), second.alias("id2")), "toxic-ids")
        found, _ = rows.split_by_ids(found.withColumns({"id1": first, "id2": second}), "id1", "id2", ids)
    return found.join(keys, "train_key").select(plain_words(F.col("text")).alias("text"), "toxic", "aside")


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_train: int = MAX_TRAIN,
    frequent: int = FREQUENT,
    head: int = HEAD,
) -> Fitted:
    """The models of the labelled documents that are not held out, and the curve. Without labels every score is 0.5."""
    keys = checkpoint_table(training_keys(labels, key, label), "toxic-labels")
    keys = keys.join(F.broadcast(curve_keys(keys, max_train)), "train_key", "left")
    keys = checkpoint_table(keys.select("train_key", "toxic", F.coalesce("aside", F.lit(False)).alias("aside")), "toxic-keys")
    train = labelled(documents, keys, key, text)
    spelling = ngrams.Spelling(ngrams.fit(train.filter("NOT aside"), only_words=True), frequent, head)
    folders = [ngrams.fit(train.filter(f"NOT aside AND {which}"), spelling=spelling, caps=DISCOUNTS) for which in ("toxic = 1", "toxic <> 1")]
    fitted = Fitted(folders, spelling, DISCOUNTS[0], (0.0, 0.0, 0.0))
    sample = train.filter("aside").select(F.col("toxic").cast("long").alias("doc_id"), "text")
    sample = evidence(sample, fitted, DISCOUNTS).toArrow()
    y = sample.column("doc_id").to_numpy() == 1
    if not len(y) or y.all() or not y.any():
        return fitted._replace(curve=(0.0, 1.0, 0.0)) if len(y) else fitted
    tried = []
    for i, cap in enumerate(DISCOUNTS):
        x = np.stack([sample.column(f"stretch{i}").to_numpy(), sample.column(f"mean{i}").to_numpy()], 1)
        curve = fit_curve(x, y)
        tried.append((lost(curve, x, y), cap, curve))
    _, cap, curve = min(tried)
    return fitted._replace(discount=cap, curve=curve)


def toxicity(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Cases: null, empty and wordless texts have evidence 0 and the score that goes with it; null keys stay and are not held out; repeated
    rows stay; texts count whole; ties cannot occur; further columns are left out; empty tables: no rows, or scores of 0.5 without labels.
    """
    fitted = fit(documents, labels, key, text, label, **options)
    constant, stretch, mean = fitted.curve
    found = evidence(documents.select(F.col(f"`{key}`").alias("doc_id"), plain_words(F.col(f"`{text}`")).alias("text")), fitted)
    linear = F.lit(constant) + F.lit(stretch) * F.col("stretch0") + F.lit(mean) * F.col("mean0")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))
    out = found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
