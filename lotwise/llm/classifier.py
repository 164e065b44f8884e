"""Quality classifier over random-indexing word vectors.

Every word (a run of letters and digits, or of other signs; case kept) has a
slot, and every slot a sparse index vector of a few +1 and -1 at places that
its number decides. A slot's word vector is the sum of the index vectors of
all words within WINDOW of its occurrences, over all documents: one pass of
additions, no labels. Vectors are brought to unit length. A document is pooled
into the mean and the spread of its words' vectors, with the shares of words
that are new and of neighbours that are the same. A network of two layers, in numpy, learns from pooled documents with
labels, and a temperature, fitted on labelled documents that the network
didn't see, makes its outputs probabilities.

The word vectors and the network are of fixed size (SLOTS x WIDTH numbers),
however large the corpus; their partial sums are added up in two steps, so
that no task reads all of them. The network is fitted on a sample of labelled
rows: at most SAMPLE_PER_CLASS ids of each class, weighted back to the labels'
proportions.

Defined results: null and empty texts have a zero vector and the score that
the network gives it; without labels of both classes every score is 0.5; texts
of any length are pooled whole; several labels of one id count as good only if
all do, null labels are left out; repeated rows and ties get equal scores; an
empty table gives no rows; further columns, whatever their names, are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.langid import Cached
from lotwise.llm.text import fold, small_batches

SLOTS = 1 << 15
WIDTH = 64
MARKS = 4  # places of an index vector that aren't 0
WINDOW = 2
TOKENS = 1 << 18  # words whose neighbours are added together
PIECES = 32  # parts of the table of vectors, summed apart
HIDDEN = 32
SAMPLE_PER_CLASS = 2000  # labelled ids of each class that the fit may see
GOOD = 0.7
WORDS = re.compile(r"\w+|[^\w\s]+")


def slot(word: str) -> int:
    return crc32(word.encode()) % SLOTS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of every slot, SLOTS x MARKS."""
    rng = np.random.default_rng(11)
    return rng.integers(0, WIDTH, (SLOTS, MARKS)), np.where(np.arange(MARKS) % 2 == 0, 1, -1)


def add_context(sums: np.ndarray, at: np.ndarray, text: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Adds to sums (SLOTS * WIDTH) the index vectors of the neighbours of each word. at: slots; text: the text each is of."""
    for step in range(1, WINDOW + 1):
        same = text[step:] == text[:-step]
        left, right = at[:-step][same], at[step:][same]
        for a, b in ((left, right), (right, left)):
            for k in range(MARKS):
                np.add.at(sums, a * WIDTH + places[b, k], signs[k])


def packed(sums: np.ndarray) -> bytes:
    return pa.compress(sums.astype(np.int64).tobytes(), codec="zstd", asbytes=True)


def unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(body, SLOTS // PIECES * WIDTH * 8, codec="zstd", asbytes=True), np.int64)


def partial_sums(docs: DataFrame) -> DataFrame:
    """part, piece, body: each task's sums of neighbours."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, known = np.zeros(SLOTS * WIDTH, np.int64), Cached(slot)
        places, signs = index_vectors()
        at: list[np.ndarray] = []
        waiting = 0

        def settle() -> None:
            nonlocal waiting
            if at:
                add_context(sums, np.concatenate(at), np.repeat(np.arange(len(at)), [len(a) for a in at]), places, signs)
            at.clear()
            waiting = 0

        for batch in batches:
            for text in batch["text"]:
                found = WORDS.findall(text) if text else ()
                at.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
                waiting += len(found)
                if waiting >= TOKENS:
                    settle()
        settle()
        part = TaskContext.get().partitionId()
        yield pd.DataFrame([(part, k, packed(x)) for k, x in enumerate(np.split(sums, PIECES)) if x.any()], columns=["part", "piece", "body"])

    return docs.select("text").mapInPandas(run, "part long, piece long, body binary")


def added(rows: DataFrame, *by: str) -> DataFrame:
    """part, piece, body: the sums of the rows of each group, read as a stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, piece, body in zip(batch["part"], batch["piece"], batch["body"], strict=True):
                key = (part, piece)
                sums[key] = sums[key] + unpacked(body) if key in sums else unpacked(body)
        yield pd.DataFrame([(a, b, packed(x)) for (a, b), x in sums.items()], columns=["part", "piece", "body"])

    return rows.repartition(*by).mapInPandas(run, "part long, piece long, body binary")


def word_vectors(docs: DataFrame) -> np.ndarray:
    """SLOTS x WIDTH vectors of unit length (0 where a slot has no neighbours)."""
    groups = max(1, isqrt(docs.rdd.getNumPartitions()))
    few = added(partial_sums(docs).withColumn("part", F.pmod("part", F.lit(groups))), "part", "piece")
    whole = added(few.withColumn("part", F.lit(0).cast("long")), "piece")
    out = np.zeros((PIECES, SLOTS // PIECES * WIDTH))
    for r in whole.collect():  # PIECES rows, or fewer
        out[r.piece] = unpacked(r.body)
    out = out.reshape(SLOTS, WIDTH)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


class Pool:
    """Texts -> mean and spread of their words' vectors, and the shares of distinct words and of equal neighbours."""

    size = 2 * WIDTH + 2

    def __init__(self, vectors: np.ndarray) -> None:
        self.both = np.concatenate([vectors, vectors * vectors], axis=1)
        self.known = Cached(slot)

    def __call__(self, text: str | None) -> np.ndarray:
        found = WORDS.findall(text) if text else ()
        if not found:
            return np.zeros(self.size)
        at = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        words, times = np.unique(at, return_counts=True)
        mean, square = np.split(((times / len(at)).astype(np.float32) @ self.both[words]).astype(float), 2)
        return np.concatenate([mean, np.sqrt(np.maximum(square - mean * mean, 0)), [len(words) / len(at), (at[1:] == at[:-1]).sum() / len(at)]])


@dataclass
class Network:
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.first + self.first_bias) @ self.second + self.second_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, rate: np.ndarray, *, epochs: int = 60, step: float = 3e-3, decay: float = 1e-3, batch: int = 64) -> Network:
    """Weighted log loss by Adam with weight decay; rate: each row's weight."""
    rng = np.random.default_rng(5)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - centre) / scale
    w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    mean, square = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    turn = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(z)), -(-len(z) // batch)):
            turn += 1
            h = np.tanh(z[at] @ w[0] + w[1])
            d = rate[at] * (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -40, 40))) - y[at]) / len(at)
            back = d[:, None] * w[2] * (1 - h * h)
            grads = [z[at].T @ back + decay * w[0], back.sum(axis=0), h.T @ d + decay * w[2], d.sum(keepdims=True)]
            for k, g in enumerate(grads):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w[k] = w[k] - step * (mean[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.999**turn)) + 1e-8)
    return Network(centre, scale, w[0], w[1], w[2], float(w[3][0]))


def fit_temperature(logits: np.ndarray, y: np.ndarray, rate: np.ndarray) -> float:
    """The divisor of the logits with the least weighted log loss; 1 without rows.

    Labels count as Platt's targets, (n + 1) / (n + 2) of a class of n, so that rows without a mistake don't make it sure.
    """
    if not len(y):
        return 1.0
    n = (y == 1).sum()
    aim = np.where(y == 1, (n + 1) / (n + 2), 1 / (len(y) - n + 2))
    each = np.exp(np.linspace(np.log(0.2), np.log(20), 400))
    loss = [(rate * (aim * np.logaddexp(0, -logits / t) + (1 - aim) * np.logaddexp(0, logits / t))).sum() for t in each]
    return float(each[int(np.argmin(loss))])


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None

    def scorer(self):
        pool = Pool(self.vectors)

        def score(texts) -> np.ndarray:
            if self.network is None:
                return np.full(len(texts), 0.5)
            return self.network.probability(np.stack([pool(t) for t in texts])) if len(texts) else np.zeros(0)

        return score


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """labels: doc_id, quality (0 or 1), one row an id. The sample is drawn from the labels: at most per_class ids of each class."""
    spark = docs.sparkSession
    small_batches(spark)
    vectors = word_vectors(docs)
    labels = labels.filter(F.col("quality").isin(0, 1))
    counts = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return Model(vectors, None)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    few = [labels.filter(F.col("quality") == q).select(draw.alias("draw"), "doc_id", "quality").orderBy("draw", "doc_id").limit(per_class) for q in (0, 1)]
    kept = docs.select("doc_id", "text").join(F.broadcast(few[0].unionByName(few[1])), "doc_id")  # at most 2 * per_class ids: no text is shuffled
    held = spark.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = Pool(held.value)
        for b in batches:
            yield pd.DataFrame({"draw": b["draw"], "doc_id": b["doc_id"], "quality": b["quality"], "pooled": [pool(t).astype(np.float32).tobytes() for t in b["text"]]})

    # a row an id and text; ids that repeat beyond the sample's size are thinned out
    rows = kept.mapInPandas(run, "draw long, doc_id long, quality int, pooled binary").dropDuplicates(["doc_id", "pooled"])
    got = rows.orderBy("draw", "doc_id", "pooled").limit(4 * per_class).toPandas()
    y = got["quality"].to_numpy()
    if len(set(y)) < 2:
        return Model(vectors, None)
    x = np.stack([np.frombuffer(p, np.float32) for p in got["pooled"]]).astype(float)
    share = np.array([counts[q] / (y == q).sum() for q in (0, 1)])
    rate = (share / share.mean())[y]
    rate = rate / rate.mean()
    aside = np.arange(len(y)) % 5 == 4
    if len(set(y[~aside])) < 2:
        aside[:] = False
    network = fit(x[~aside], y[~aside], rate[~aside])
    network.temperature = fit_temperature(network.logit(x[aside]), y[aside], rate[aside])
    return Model(vectors, network)


def train_fold(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from the labels of documents outside the held-out fold."""
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    return train(docs, usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))


def score_column(model: Model, spark, text: Column) -> Column:
    held = spark.sparkContext.broadcast(model)  # SLOTS x WIDTH floats

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = held.value.scorer()
        for texts in batches:
            yield pd.Series(score(texts), dtype=float)

    return run(text)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. docs: doc_id, text; labels: doc_id, quality."""
    spark = docs.sparkSession
    model = train_fold(docs.select("doc_id", "text"), labels)
    out = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), score_column(model, spark, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
