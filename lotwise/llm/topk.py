"""Exact top-k inner products by no-random-access aggregation.

Rows are dealt into blocks; each keeps one list per dimension of (value, row),
sorted by value. A query reads every list of a block from the end that its own
component favours, in growing steps, all lists equally far. What has been read
of a candidate is summed up: with the last value read of each list it lacks
that makes an upper bound, with the list's worst value a lower one. Sums and
what is known of each candidate are arrays that a step updates from the newly
read entries only. Candidates whose upper bound lies below the k-th lower
bound are out. A query stops when no outsider can qualify: k are left, or so
few that resolving them costs less than the next step (fewer candidates than
it would read from each list). Their final scores are then resolved.

A query first reads one block of its own; the k-th score found there is the
bar for all other blocks. A block's largest and smallest components bound what
any of its rows can score, so blocks that can't reach the bar are never read.
A last step keeps the best k of a query over all blocks. Queries of a batch
read the lists together, as matrix products with the entries of a step.

Defined results: vectors that are null or hold nulls, NaN or infinities, and
rows with a null id, take no part; vectors of different lengths are not
compared; repeated rows are candidates each, and one query; rows with the
query's id are its own; ties go to the smaller id; an empty table gives no
rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.session import cut

K = 20
EVERY = 20
FACTOR = 64
BLOCK_ROWS = 8192
BATCH_QUERIES = 8192
CHUNK = 256  # queries whose bounds are held at once
STEPS = (0.25, 0.5, 0.7, 0.85, 1.0)  # depths of reading, in shares of the lists
TOGETHER = 0.25  # while more candidates are in, queries take their steps together
FOUND = "query_id long, query_mix long, vec_id long, score long, depth double, entries long, resolved long"


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = np.asarray(flat.flatten())
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def exact_type(q: np.ndarray, x: np.ndarray) -> type:
    """The fastest type in which every partial sum is an exact integer."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


class Lists:
    """A block's lists: of each dimension the rows and their values, largest first."""

    def __init__(self, x: np.ndarray) -> None:
        self.rows = np.argsort(-x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.rows, axis=0)

    def __len__(self) -> int:
        return len(self.rows)

    def depth(self, i: int) -> int:
        """Entries of each list that have been read after step i - 1."""
        return max(1, int(len(self) * STEPS[i - 1])) if i else 0

    def entries(self, i: int, top: bool) -> tuple[np.ndarray, np.ndarray]:
        """(rows, values) that step i reads from the upper or the lower ends, a column a dimension."""
        lo, hi = self.depth(i), self.depth(i + 1)
        part = slice(lo, hi) if top else slice(len(self) - hi, len(self) - lo)
        return self.rows[part], self.values[part]


class Reading:
    """What some queries have read of some rows of a block: sums of the entries, and which lists have shown a row."""

    def __init__(self, lists: Lists, q: np.ndarray, rows: np.ndarray | None = None) -> None:
        self.lists, self.step = lists, 0
        self.q = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)  # components that read from above, and from below
        n, dims = len(lists), q.shape[1]
        self.place = np.full(n, -1)
        rows = np.arange(n) if rows is None else rows
        self.place[rows] = np.arange(len(rows))
        self.seen = np.zeros((len(rows), 2 * dims), q.dtype)  # 1 where a list has shown the row
        self.sums = np.zeros((len(q), len(rows)), q.dtype)
        self.read = 0

    def advance(self) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) after the next step."""
        lists, dims = self.lists, self.seen.shape[1] // 2
        new = np.zeros_like(self.seen)
        for top in (True, False):
            rows, values = lists.entries(self.step, top)
            at = self.place[rows]
            column = np.broadcast_to(np.arange(dims) + (0 if top else dims), at.shape)
            ours = at >= 0
            new[at[ours], column[ours]] = values[ours]
            self.seen[at[ours], column[ours]] = 1
            self.read += rows.size
        self.sums += self.q @ new.T
        self.step += 1
        depth = lists.depth(self.step)
        last = np.concatenate([lists.values[depth - 1], lists.values[-depth]])
        worst = np.concatenate([lists.values[-1], lists.values[0]])
        both = np.concatenate([self.q * worst, self.q * last])
        known = both @ self.seen.T  # what lists that have shown a row would have given at their worst, or last
        rest = both.sum(axis=1, keepdims=True) - known
        k = len(self.q)
        return self.sums + rest[:k], self.sums + rest[k:]

    def narrow(self, rows: np.ndarray) -> None:
        """Goes on with these of the rows only."""
        place = np.full(len(self.lists), -1)
        old = np.flatnonzero(self.place >= 0)
        order = np.argsort(self.place[old])
        place[old[order][rows]] = np.arange(len(rows))
        self.place, self.seen, self.sums = place, self.seen[rows], self.sums[:, rows]


def kth(values: np.ndarray, k: int, least) -> np.ndarray:
    """The k-th largest of each row; `least` where there are fewer."""
    n = values.shape[-1]
    return np.partition(values, n - k, axis=-1)[..., n - k] if n >= k else np.full(values.shape[:-1], least)


def search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, bars: list[int | None]) -> list[tuple[int, int, int, float, int, int]]:
    """(query, candidate, score, depth read, entries read, candidates resolved) of the k best of each query that reach its bar; ids ascend."""
    kind = exact_type(q, x)
    least = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    x = x.astype(kind)
    lists, out = Lists(x), []
    for lo in range(0, len(q), CHUNK):
        part, names = q[lo : lo + CHUNK].astype(kind), q_ids[lo : lo + CHUNK]
        bar = np.array([least if b is None else b for b in bars[lo : lo + CHUNK]], kind if kind is np.int64 else np.float64)
        own = names[:, None] == ids[None, :]
        alive, shared = ~own, Reading(lists, part)
        while shared.step < len(STEPS) - 1 and alive.mean() > TOGETHER:
            lower, upper = shared.advance()
            lower[own] = least
            bar = np.maximum(bar, kth(lower, k, least))
            alive &= upper >= bar[:, None]
        for row, v in enumerate(part):  # each query with its own candidates and depth from here
            at, b = np.flatnonzero(alive[row]), bar[row]
            step, entries = shared.step, shared.read // 2
            if step < len(STEPS) and len(at) > max(k, lists.depth(step + 1) - lists.depth(step)):
                mine = Reading(lists, v[None], at)
                mine.seen, mine.sums, mine.step = shared.seen[at], shared.sums[row : row + 1, at], step
                while mine.step < len(STEPS) and len(at) > max(k, lists.depth(mine.step + 1) - lists.depth(mine.step)):
                    lower, upper = mine.advance()
                    b = max(b, kth(lower[0], k, least))
                    left = np.flatnonzero(upper[0] >= b)
                    at = at[left]
                    mine.narrow(left)
                step, entries = mine.step, entries + mine.read // 2
            scores = x[at] @ v
            best = np.argsort(-scores, kind="stable")[:k]
            read = STEPS[step - 1] if step else 0.0
            out += [(lo + row, int(at[i]), int(scores[i]), read, entries, len(at)) for i in best]
    return out


def cell(a: pa.Table, b: pa.Table, k: int) -> pa.Table:
    """The best of a block for some queries; a: query rows with their bars, b: the block."""
    schema = pa.schema([("query_id", pa.int64()), ("query_mix", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("depth", pa.float64()), ("entries", pa.int64()), ("resolved", pa.int64())])
    if not len(a) or not len(b):
        return schema.empty_table()
    b = b.sort_by("vec_id")
    ids, q_ids, mixes = (np.asarray(c) for c in (b["vec_id"], a["vec_id"], a["mix"]))
    got = search(matrix(a["v"]), q_ids, matrix(b["v"]), ids, k, a["bar"].to_pylist())
    q, c, s, d, e, r = (np.array(v) for v in zip(*got, strict=True)) if got else (np.zeros(0, np.int64),) * 6
    return pa.table([q_ids[q], mixes[q], ids[c], s, d.astype(float), e, r], schema=schema)


def boxes(rows: DataFrame) -> DataFrame:
    """dim, bl, high, low: the largest and smallest components of every block."""
    each = rows.select("dim", "bl", F.posexplode("v").alias("d", "x")).groupBy("dim", "bl", "d").agg(F.max("x").alias("hi"), F.min("x").alias("lo"))
    ends = F.array_sort(F.collect_list(F.struct("d", "hi", "lo")))  # as many as dimensions
    return each.groupBy("dim", "bl").agg(ends.alias("ends")).select("dim", "bl", F.col("ends.hi").alias("high"), F.col("ends.lo").alias("low"))


def most() -> Column:
    """What no row of a block can exceed: each component of the query with the block's largest or smallest one."""
    each = F.zip_with(F.col("v"), F.arrays_zip("high", "low"), lambda q, e: F.when(q > 0, q * e["high"]).otherwise(q * e["low"]))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)


def top_k(rows: DataFrame, k: int = K, every: int = EVERY, block_rows: int = BLOCK_ROWS, batch: int = BATCH_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score, and how much was read for it: depth of the block's lists, entries of them, candidates resolved there.

    rows: vec_id, v (array<long>).
    """
    mix = F.xxhash64("vec_id", "v")
    rows = cut(rows.select("vec_id", "v", F.size("v").alias("dim"), mix.alias("mix")))
    asks = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id", "v"])
    counts = rows.agg(F.count("*").alias("n"), F.count_if(F.pmod("vec_id", F.lit(every)) == 0).alias("q")).first()
    blocks, batches = max(1, -(-counts.n // block_rows)), max(1, -(-counts.q // batch))
    asks = asks.select(*[F.col(c).alias(c) for c in asks.columns])  # columns of their own, apart from those of the rows
    left = asks.withColumns({"bt": F.pmod(F.shiftrightunsigned("mix", 20), F.lit(batches)).cast("int"), "home": F.pmod("mix", F.lit(blocks)).cast("int")})
    right = rows.withColumn("bl", F.pmod("mix", F.lit(blocks)).cast("int")).drop("mix")
    key = ["dim", "bl", "bt"]

    def read(queries: DataFrame) -> DataFrame:
        """Queries with the blocks (bl) that they read: a block goes to the batches that ask for it."""
        queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # columns of their own again
        asked = queries.select(*[F.col(c).alias(f"a_{c}") for c in key]).distinct()
        sent = right.join(asked, (F.col("dim") == F.col("a_dim")) & (F.col("bl") == F.col("a_bl"))).select("vec_id", "v", "dim", "bl", F.col("a_bt").alias("bt"))
        return queries.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(lambda a, b: cell(a, b, k), FOUND)

    found = read(left.withColumns({"bl": F.col("home"), "bar": F.lit(None).cast("long")}))
    if blocks > 1:
        found = cut(found)
        bars = found.groupBy(F.col("query_id").alias("vec_id"), F.col("query_mix").alias("mix")).agg(F.when(F.count("*") >= k, F.min("score")).alias("bar"))
        others = left.join(bars, ["vec_id", "mix"], "left").join(boxes(right), "dim").filter("bl <> home")
        found = found.unionByName(read(others.filter(F.col("bar").isNull() | (most() >= F.col("bar"))).drop("high", "low")))
    w = W.partitionBy("query_id", "query_mix").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "depth", "entries", "resolved")


def integers(embeddings: DataFrame, factor: int = FACTOR) -> DataFrame:
    """vec_id, v: the components as floor(factor * x), of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad))
    return usable.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v"))


def digest(embeddings: DataFrame) -> DataFrame:
    return top_k(integers(embeddings.select("vec_id", "embedding"))).select("query_id", "rank", "vec_id", "score")


#: The same rows in SQL, over all pairs of queries and rows.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.v AS of, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v) q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, of ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
