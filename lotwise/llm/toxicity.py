"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from a
logistic model over its distinct words and their beginnings, so that inflected
and compound forms share evidence (hashed to a fixed number of slots);
the document's probability is their noisy-or, 1 - prod(1 - p). The model is
fitted to document labels only, by adaptive gradients with soft thresholding,
on a sample of labelled rows that is bounded in rows and in bytes, weighted
back to the labels' proportions. Afterwards the sentence probabilities point
at the offending sentences.

Defined results: null and empty texts have no sentence and score 0; so does
every text when no label can be learned from; texts of any length are scored
whole, but one that alone exceeds the sample's bytes is not learned from;
repeated rows and ties get equal scores; several labels of one id count as
toxic if any is; null labels are left out; an empty table gives no rows;
further columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.langid import Cached
from lotwise.llm.text import fold, small_batches

SLOTS = 1 << 20
BEGINNINGS = (3, 4, 5, 6)  # letters
SAMPLE_PER_CLASS = 2000  # labelled rows of each class that the fit may see
SAMPLE_BYTES = 48 << 20  # packed slots of each class that the fit may see
TOXIC_WEIGHT = 3.0
STOP = re.compile(r"[.!?\n]+")
WORDS = re.compile(r"[^\W_]+")


def slots(word: str) -> list[int]:
    """Slots of a word: itself, and its beginnings."""
    return [zlib.crc32(w.encode()) % SLOTS for w in (word, *[f"{word[:n]}-" for n in BEGINNINGS if len(word) >= n])]


def sentences(text: str | None) -> list[str]:
    return [s for s in STOP.split(text.lower()) if s] if text else []


def encode_bag(text: str | None, known: Cached) -> tuple[bytes, bytes]:
    """Slots of the distinct words of each sentence, concatenated, and their counts."""
    bags = [b for s in sentences(text) if (b := [i for w in sorted(set(WORDS.findall(s))) for i in known[w]])]
    return np.array([i for b in bags for i in b], np.int32).tobytes(), np.array([len(b) for b in bags], np.int32).tobytes()


@dataclass
class Model:
    weights: np.ndarray  # SLOTS
    bias: float
    fitted: bool

    def scorer(self):
        """text -> probabilities of its sentences."""
        known = Cached(lambda w: float(self.weights[slots(w)].sum()))
        bias = self.bias

        def score(parts: list[str]) -> np.ndarray:
            if not parts or not self.fitted:
                return np.zeros(len(parts))
            z = np.array([sum([known[w] for w in set(WORDS.findall(s))]) for s in parts]) + bias
            return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

        return score


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-15)).sum()))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], ys: np.ndarray, rate: np.ndarray, *, epochs: int = 10, step: float = 0.8, l1: float = 3e-4) -> Model:
    """rate: each row's weight; the loss is the weighted negative log-likelihood of the noisy-or."""
    w, seen = np.zeros(SLOTS), np.full(SLOTS, 1e-2)
    bias, seen_bias = -5.0, 1e-2
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(bags)):
            at, sizes = bags[i]
            if not len(sizes):
                continue
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            z = np.add.reduceat(w[at], starts) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            none = np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())
            g = rate[i] * (-none / max(1 - none, 1e-9) * p if ys[i] else p)
            each = np.repeat(g, sizes)
            here, where = np.unique(at, return_inverse=True)
            grad = np.bincount(where, each)
            seen[here] += grad * grad
            lr = step / np.sqrt(seen[here])
            moved = w[here] - lr * grad
            w[here] = np.sign(moved) * np.maximum(np.abs(moved) - lr * l1, 0)
            seen_bias += g.sum() ** 2
            bias -= step / np.sqrt(seen_bias) * g.sum()
    return Model(w.astype(np.float32), float(bias), True)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """labels: doc_id, toxic (0 or 1), one row an id. The sample is drawn from the labels: at most per_class ids of each class."""
    spark = docs.sparkSession
    small_batches(spark)
    labels = labels.filter(F.col("toxic").isin(0, 1))
    counts = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    none = Model(np.zeros(SLOTS, np.float32), 0.0, False)
    if len(counts) < 2:
        return none
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    ids = None
    for label in sorted(counts):
        few = labels.filter(F.col("toxic") == label).select(draw.alias("draw"), "doc_id", "toxic").orderBy("draw", "doc_id").limit(per_class)
        ids = few if ids is None else ids.unionByName(few)
    kept = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 * per_class ids: no text is shuffled

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Cached(slots)
        for b in batches:
            got = [encode_bag(t, known) for t in b["text"]]
            yield pd.DataFrame({"draw": b["draw"], "doc_id": b["doc_id"], "toxic": b["toxic"], "slots": [g[0] for g in got], "sizes": [g[1] for g in got]})

    packed = kept.mapInPandas(features, "draw double, doc_id long, toxic int, slots binary, sizes binary")
    size = F.length("slots") + F.length("sizes")
    drawn = W.partitionBy("toxic").orderBy("draw", "doc_id", "slots")  # 2 * per_class ids at most
    few = packed.filter(size <= SAMPLE_BYTES).withColumn("bytes", F.sum(size).over(drawn)).filter(F.col("bytes") <= SAMPLE_BYTES).drop("bytes")
    few = few.toPandas().sort_values(["draw", "doc_id", "toxic"], ignore_index=True)
    ys = few["toxic"].to_numpy()
    if len(set(ys)) < 2:
        return none
    share = {label: n / max(1, int((ys == label).sum())) for label, n in counts.items()}
    rate = np.array([share[y] for y in ys])
    bags = [(np.frombuffer(s, np.int32), np.frombuffer(n, np.int32)) for s, n in zip(few["slots"], few["sizes"], strict=True)]
    # toxic rows are few, and missing one costs more than a doubt
    return fit(bags, ys, rate / rate.mean() * np.where(ys == 1, TOXIC_WEIGHT, 1.0))


def train_fold(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from the labels of documents outside the held-out fold."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return train(docs, one)


def score_column(model: Model, spark, text: Column) -> Column:
    held = spark.sparkContext.broadcast(model)  # SLOTS floats

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = held.value.scorer()
        for texts in batches:
            yield pd.Series([noisy_or(score(sentences(t))) for t in texts], dtype=float)

    return run(text)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    small_batches(docs.sparkSession)
    model = train_fold(docs, labels)
    out = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), score_column(model, docs.sparkSession, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def locate(docs: DataFrame, model: Model, at_least: float = 0.5) -> DataFrame:
    """doc_id, start, end, sentence, score of the sentences with that probability; offsets are in code points."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    whole = re.compile(r"[^.!?\n]+")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = held.value.scorer()
        for b in batches:
            out = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                spans = list(whole.finditer(text or ""))
                probs = score([m[0].lower() for m in spans])
                out += [(doc_id, m.start(), m.end(), m[0], float(p)) for m, p in zip(spans, probs, strict=True) if p >= at_least]
            yield pd.DataFrame(out, columns=["doc_id", "start", "end", "sentence", "score"])

    return docs.select("doc_id", "text").mapInPandas(find, "doc_id long, start int, end int, sentence string, score double")
