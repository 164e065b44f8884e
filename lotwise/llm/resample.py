"""Importance resampling towards a target distribution.

Words and word pairs are hashed to a fixed number of buckets. Over all
documents and over the target's texts the occurrences of each bucket are
counted, which gives an array of gains: the log ratio of a bucket's share in
the target to its share in the documents. A document's weight is the mean gain
of its features, looked up in that array. A draw without replacement in
proportion to exp(weight) takes the highest sums of weight and Gumbel noise,
the noise being a hash of the id, so reruns agree.

The k-th highest of all scores is found by distributed quickselect: random
rows of the open range are pivots, every row is counted below, at or above
each of them, and the range narrows to the part that holds the k-th key. Keys
are composite (score, id, features, record), so no two are equal and exactly k
are drawn. Only these are sorted, by ranges, and ranked.

Texts are read twice (counts, weights) rather than written down as features;
what reaches the driver are arrays by bucket, pivots and counts by pivot.

Defined results: null and empty texts have no features and weight 0; texts of
any length count whole; documents with fewer than `least` words are never
drawn, but scored; without target texts the gains are those of an empty
target; a null id is hashed as an empty one and stands last among equal
scores; repeated rows are records of their own; an empty table gives no rows;
further columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.langid import Cached
from lotwise.llm.text import small_batches
from lotwise.session import place, stored

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
PIVOTS = 15  # rows that a round of the selection compares all others with
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 with A-Z lower-cased
KEY = ("neg", "nameless", "doc_id", "n_features", "row")  # ascending: the highest score first, then the smallest id


def utf8(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw")


class Hashed:
    """Buckets of the features of texts."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        # a word's own checksum, and that of the word and a space, from which a pair's follows
        self.known = Cached(lambda w: (crc32(w), crc32(w + b" ")))

    def __call__(self, raw: bytes) -> tuple[int, np.ndarray]:
        """(words, bucket of every feature)."""
        words = WORD.findall(raw.lower())
        if not words:
            return 0, np.zeros(0, np.int64)
        single, first = zip(*map(self.known.__getitem__, words), strict=True)
        pairs = list(map(crc32, words[1:], first))
        return len(words), np.array([*single, *pairs], np.int64) % self.buckets


def counted(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of each bucket in all texts; as many rows as buckets reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, sums = Hashed(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch["raw"]:
                sums += np.bincount(hashed(raw)[1], minlength=buckets)
        at = sums.nonzero()[0]
        yield pd.DataFrame({"bucket": at, "n": sums[at]})

    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.select(utf8("text")).mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the buckets' shares, with one added count each, rounded down."""
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    held = docs.sparkSession.sparkContext.broadcast(gain)  # a number for each bucket

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gain = held.value
        hashed = Hashed(len(gain))
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for raw in batch["raw"]:
                n, found = hashed(raw)
                n_words.append(n)
                n_features.append(len(found))
                weights.append(int(gain[found].sum()) // max(1, len(found)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": n_words, "n_features": n_features, "weight": weights})

    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), utf8("text"))
    out = docs.mapInPandas(run, "doc_id string, n_words long, n_features long, weight long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel number that follows from seed and id, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def key_of(row: Row) -> Column:
    """A row's key as a constant."""
    kinds = {"neg": "long", "nameless": "boolean", "doc_id": "long", "n_features": "long", "row": "long"}
    return F.struct(*[F.lit(row[c]).cast(kinds[c]).alias(c) for c in KEY])


def order(row: Row) -> tuple:
    return tuple(0 if row[c] is None else row[c] for c in KEY)


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> Row:
    """The k-th smallest key (from 1) of rows with the columns of KEY, no two of them equal; k of them at least."""
    rows = rows.select(*KEY)
    low = high = None
    turn = 0
    while True:
        within = rows
        if low is not None:
            within = within.filter(F.struct(*KEY) > key_of(low))
        if high is not None:
            within = within.filter(F.struct(*KEY) < key_of(high))
        few = sorted(within.orderBy(F.xxhash64(F.lit(seed), F.lit(turn), "row"), "row").limit(pivots).collect(), key=order)
        # 2 * i: between pivot i - 1 and pivot i; 2 * i + 1: pivot i itself
        at = sum(((F.struct(*KEY) > key_of(p)).cast("int") + (F.struct(*KEY) >= key_of(p)).cast("int") for p in few), F.lit(0))
        counts = dict(within.groupBy(at.alias("at")).count().collect())
        for part in range(2 * len(few) + 1):
            n = counts.get(part, 0)
            if k <= n:
                break
            k -= n
        if part % 2:
            return few[part // 2]
        low = few[part // 2 - 1] if part else low
        high = few[part // 2] if part // 2 < len(few) else high
        turn += 1


def ranked(rows: DataFrame, where: str) -> DataFrame:
    """rows with rank by KEY. Rows are sorted in ranges; the ranges before one give its first rank."""
    placed = stored(rows.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), where)
    before = placed.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(W.orderBy("part")) - F.col("n")).select("part", "before")  # a row a range
    at = F.row_number().over(W.partitionBy("part").orderBy(*KEY))
    return placed.withColumn("at", at).join(F.broadcast(before), "part").withColumn("rank", (F.col("before") + F.col("at")).cast("long")).drop("part", "at", "before")


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document. target: text."""
    small_batches(docs.sparkSession)
    gain = gains(counted(docs, buckets), counted(target, buckets))
    return weighted(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it isn't drawn.

    docs: doc_id, text; target: text. Scores are written to the shared folder.
    """
    where = place(docs.sparkSession, "resample")
    names = {"neg": -F.col("score"), "nameless": F.col("doc_id").isNull(), "row": F.monotonically_increasing_id()}
    rows = stored(scored(docs, target, buckets, seed).withColumns(names), f"{where}/scores")
    fit = F.col("n_words") >= least
    k = rows.filter(fit).count() * percent // 100
    if not k:
        return rows.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    last = key_of(kth_key(rows.filter(fit), k, seed=seed))
    won = fit & (F.struct(*KEY) <= last)
    drawn = ranked(rows.filter(won), f"{where}/drawn")
    rest = rows.filter(~won).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


#: resample() with its defaults in SQL; checksums are made from the bytes of every distinct feature.
SQL = r"""
WITH table_ AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(n AS BIGINT))) AS t
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), f AS MATERIALIZED (
  SELECT r, feature, count(*) AS n FROM (SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM d) GROUP BY ALL
), g AS MATERIALIZED (
  SELECT feature, count(*) AS n FROM (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM b) GROUP BY ALL
), k AS MATERIALIZED (
  SELECT feature, xor(list_reduce(list_transform(range(1, CAST(len(h) // 2 AS BIGINT) + 1), lambda i: CAST(16 * (instr('0123456789ABCDEF', h[2 * i - 1]) - 1) + instr('0123456789ABCDEF', h[2 * i]) - 1 AS BIGINT)),
      lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, hex(encode(feature)) AS h FROM (SELECT feature FROM f UNION SELECT feature FROM g)), table_
), s AS (
  SELECT bucket, CAST(sum(n) AS DOUBLE) AS s FROM f JOIN k USING (feature) GROUP BY bucket
), t AS (
  SELECT bucket, CAST(sum(n) AS DOUBLE) AS t FROM g JOIN k USING (feature) GROUP BY bucket
), gain AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (coalesce((SELECT sum(s) FROM s), 0) + 10000) / ((coalesce(s, 0) + 1) * (coalesce((SELECT sum(t) FROM t), 0) + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
), a AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM f JOIN k USING (feature) JOIN gain USING (bucket) GROUP BY r
), o AS (
  SELECT d.r, doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         CAST(('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS h
  FROM d LEFT JOIN a USING (r)
), p AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM o
), q AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, r) AS rank, 25 * count(*) OVER () // 100 AS k FROM p WHERE words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= k THEN rank END AS rank FROM p LEFT JOIN q USING (r)
"""
