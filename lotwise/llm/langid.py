"""Language identification: sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams inside words, hashed to a
fixed number of slots. Document frequencies are counted over all training
rows. The weights are fitted with follow-the-regularised-leader (proximal,
per-coordinate rates) under an elastic-net penalty on a bounded sample of
labelled rows of every language; a part of the sample that the fit doesn't see
sets the softmax temperature.

Defined results: a text that is null or has no letter is `und` with score 0,
as is every text when there is nothing to learn from; texts of any length
count whole, a task holding the distinct words of one at a time; ties between
languages go to the smaller name; repeated rows get equal results; an empty
table gives no rows; other columns, whatever their names, are neither read nor
changed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.text import fold, small_batches
from lotwise.session import cut

SLOTS = 1 << 16
GRAMS = (1, 2, 3)
SCALE = 64.0  # term frequencies are shares of a text's n-grams; this brings features near 1
SAMPLE_PER_LANG = 400  # labelled rows of each language that the fit may see
SMALL_TABLE = 100_000  # languages; the counts of as many are broadcast, of more they are joined
CACHE_WORDS = 400_000
LONG_WORD = 48
LETTERS = re.compile(r"[^\W\d_]+")


class Cached(dict):
    """word -> value; forgets everything when full, never keeps long words."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, word: str):
        got = self.make(word)
        if len(word) <= LONG_WORD:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


GRAM_SLOTS = Cached(lambda gram: zlib.crc32(gram.encode()) % SLOTS)


def slots(word: str) -> list[int]:
    """Slots of all n-grams of a word with its edges marked."""
    w, known = f" {word} ", GRAM_SLOTS
    return [known[w[i : i + n]] for n in GRAMS for i in range(len(w) - n + 1)]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counted(text: str | None) -> Counter:
    return Counter(LETTERS.findall(text.lower())) if text else Counter()


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # SLOTS
    weights: np.ndarray  # SLOTS x langs
    bias: np.ndarray
    temperature: float

    def scorer(self):
        """texts -> (language, probability) of each."""
        k = len(self.langs)
        table = np.concatenate([self.weights * (self.idf * SCALE)[:, None], np.ones((SLOTS, 1))], axis=1)
        number: dict[str, int] = {}
        rows = np.zeros((CACHE_WORDS, k + 1))  # a word's summed weights by language, and its n-grams

        def learn(words: list[str]) -> None:
            for lo in range(0, len(words), 4096):
                part = words[lo : lo + 4096]
                each = [slots(w) for w in part]
                starts = np.cumsum([0, *map(len, each[:-1])])
                sums = np.add.reduceat(table[[s for e in each for s in e]], starts, axis=0)
                rows[len(number) : len(number) + len(part)] = sums
                number.update(zip(part, range(len(number), len(number) + len(part)), strict=True))

        def one(found: Counter) -> tuple[str, float]:
            at = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
            sums = np.fromiter(found.values(), float, len(found)) @ rows[at]
            z = (sums[:-1] / max(sums[-1], 1) + self.bias) / self.temperature
            best = int(z.argmax())
            return self.langs[best], float(1 / np.exp(z - z[best]).sum())

        def score(texts: list[str | None]) -> list[tuple[str, float]]:
            out = []
            for text in texts:
                if not k or not has_letter(text):
                    out.append(("und", 0.0))
                    continue
                found = counted(text)
                new = [w for w in found if w not in number]
                if len(number) + len(new) > CACHE_WORDS:
                    number.clear()
                    new = list(found)
                if len(new) > CACHE_WORDS:  # a text with more distinct words than the cache: in parts
                    z = np.zeros(k + 1)
                    for lo in range(0, len(new), CACHE_WORDS // 2):
                        number.clear()
                        learn(new[lo : lo + CACHE_WORDS // 2])
                        z += np.array([found[w] for w in number], float) @ rows[: len(number)]
                    number.clear()
                    z = (z[:-1] / max(z[-1], 1) + self.bias) / self.temperature
                    out.append((self.langs[int(z.argmax())], float(1 / np.exp(z - z.max()).sum())))
                    continue
                if new:
                    learn(new)
                out.append(one(found))
            return out

        return score


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each slot occurs, over all rows; at most SLOTS + 1 rows reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total = np.zeros(SLOTS, np.int64), 0
        known = Cached(lambda w: np.array(slots(w), np.int32))
        for batch in batches:
            for text in batch["text"]:
                if found := set(LETTERS.findall(text.lower())) if text else ():
                    seen = np.zeros(SLOTS, bool)
                    seen[np.concatenate([known[w] for w in found])] = True
                    df += seen
                    total += 1
        at = df.nonzero()[0]
        yield pd.DataFrame({"slot": [*at.tolist(), -1], "n": [*df[at].tolist(), total]})

    out = np.zeros(SLOTS)
    total = 0
    for slot, n in rows.select("text").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():
        if slot < 0:
            total = n
        else:
            out[slot] = n
    return out, total


def sample(rows: DataFrame, per_lang: int) -> pd.DataFrame:
    """lang, slots, counts: at most per_lang rows of each language, the same at every run."""
    counts = cut(rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(2.0 * per_lang) / F.count("*")).alias("share")))
    few_langs = F.broadcast(counts) if counts.count() <= SMALL_TABLE else counts
    draw = (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0).alias("draw")
    near = rows.select("doc_id", "lang", "text", draw).join(few_langs, "lang").filter(F.col("draw") <= F.col("share"))
    order = W.partitionBy("lang").orderBy("draw", "doc_id", "text")
    few = near.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= per_lang)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Cached(slots)
        for batch in batches:
            out = []
            for lang, at, text in zip(batch["lang"], batch["at"], batch["text"], strict=True):
                tf: Counter = Counter()
                for w, n in counted(text).items():
                    for s in known[w]:
                        tf[s] += n
                if tf:
                    out.append((lang, at, np.fromiter(tf, np.int32, len(tf)).tobytes(), np.fromiter(tf.values(), np.int32, len(tf)).tobytes()))
            yield pd.DataFrame(out, columns=["lang", "at", "slots", "counts"])

    got = few.select("lang", "at", "text").mapInPandas(features, "lang string, at int, slots binary, counts binary").toPandas()
    return got.sort_values(["at", "lang"], ignore_index=True)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit_ftrl(xs: list[tuple[np.ndarray, np.ndarray]], ys: list[int], k: int, *, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01) -> np.ndarray:
    """(SLOTS + 1) x k weights; the last row is the bias."""
    z, n = np.zeros((SLOTS + 1, k)), np.zeros((SLOTS + 1, k))

    def weights(at) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for (at, x), y in zip(xs, ys, strict=True):
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / alpha * w
    return weights(np.arange(SLOTS + 1))


def fit_temperature(logits: np.ndarray, ys: np.ndarray) -> float:
    """Minimises the mean log loss of softmax(logits / t); 1 without rows."""
    if not len(ys):
        return 1.0

    def loss(log_t: float) -> float:
        z = logits / math.exp(log_t)
        top = z.max(axis=1)
        return float((top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - z[np.arange(len(ys)), ys]).mean())

    lo, hi = math.log(0.05), math.log(20)
    for _ in range(40):
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def train(rows: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """rows: doc_id, text, lang of the rows to learn from; null labels are left out."""
    small_batches(rows.sparkSession)
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    df, total = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + df)) + 1
    few = sample(rows, per_lang)
    langs = sorted(set(few["lang"]))
    xs, ys = [], []
    for lang, at, many in zip(few["lang"], few["slots"], few["counts"], strict=True):
        s, c = np.frombuffer(at, np.int32), np.frombuffer(many, np.int32)
        xs.append((np.append(s, SLOTS), np.append(c / c.sum() * idf[s] * SCALE, 1.0)))
        ys.append(langs.index(lang))
    if not langs:
        return Model([], idf, np.zeros((SLOTS, 0)), np.zeros(0), 1.0)
    aside = [i for i in range(len(xs)) if i % 5 == 4]
    seen = [i for i in range(len(xs)) if i % 5 != 4]
    w = fit_ftrl([xs[i] for i in seen], [ys[i] for i in seen], len(langs))
    logits = np.array([xs[i][1] @ w[xs[i][0]] for i in aside])
    return Model(langs, idf.astype(np.float32), w[:SLOTS].astype(np.float32), w[SLOTS], fit_temperature(logits, np.array([ys[i] for i in aside])))


def predict(model: Model, spark, text: Column) -> Column:
    """struct<lang_pred string, score double> of a text column."""
    held = spark.sparkContext.broadcast(model)  # SLOTS x languages floats: its size does not grow with the rows

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = held.value.scorer()
        for texts in batches:
            yield pd.DataFrame(score(list(texts)), columns=["lang_pred", "score"])

    return run(text)


def train_fold(docs: DataFrame) -> Model:
    """Learns from the documents outside the held-out fold."""
    return train(docs.select("doc_id", "text", "lang").filter(fold(F.col("doc_id"), 4) != 2))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    small_batches(docs.sparkSession)
    out = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), predict(train_fold(docs), docs.sparkSession, F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
