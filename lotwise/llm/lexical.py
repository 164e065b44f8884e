"""Ranked lexical search for many items at once, over shared partial scores.

An item's score of a document is a sum over its terms, so items that share
terms share partial sums. The terms of a batch of items are mined for shared
sets: pairs of nodes that stand together in at least two items become a node
of their own, the most shared first, until no pair is left. That makes a
directed graph: leaves are terms, a node is the sum of two earlier ones, an
item is the sum of what is left of it. A block of documents computes every
node's accumulator once, in the order of the graph, and all items are combined
from these.

Texts are cut into terms once: what a block of documents holds of the batch's
terms is written down packed, document frequencies and lengths are summed from
that, and scores are computed from it. A task keeps the best k of an item, and
a last step the best over all tasks. All of it is whole numbers. Items come in
batches of at most BATCH_BYTES of text, counted first (an item lies in one
batch); each batch is a graph of its own.

Defined results: null and empty texts have no terms, and such items find
nothing; texts of any length count whole; equal rows of items count once, and
items of one id with different texts are ranked apart; repeated documents are
ranked each; a null doc_id is a candidate, last among equal scores; an empty
table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.lm_score import pack, unpack
from lotwise.llm.text import small_batches
from lotwise.session import discard, place, stored

K = 20
BATCH_BYTES = 4 << 20  # text of the items that share a graph
NEAR = 16  # nodes of an item, in order of how many items hold them, among which pairs are counted
BLOCK_CELLS = 1 << 21  # accumulators that a task holds at once
HELD = 1 << 18  # candidates that a task gathers before it drops those outside the best k
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 with A-Z lower-cased: neither ASCII signs nor controls


def terms(raw: bytes) -> list[bytes]:
    return TERM.findall(raw.lower())


def utf8(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw")


@dataclass
class Graph:
    terms: dict[bytes, int]  # leaf of each term
    pairs: np.ndarray  # nodes after the leaves, as two earlier nodes each
    levels: list[np.ndarray]  # numbers of the pairs, those of a level need earlier levels only
    parts: np.ndarray  # what is left of the items, one after another
    starts: np.ndarray  # where each item begins

    def __len__(self) -> int:
        return len(self.terms) + len(self.pairs)

    def additions(self) -> int:
        return len(self.pairs) + len(self.parts) - len(self.starts)

    def combine(self, leaves: np.ndarray) -> np.ndarray:
        """Scores of the items: leaves (terms x documents) -> items x documents."""
        at = np.zeros((len(self), leaves.shape[1]), np.int64)
        at[: len(leaves)] = leaves
        for level in self.levels:
            at[len(leaves) + level] = at[self.pairs[level, 0]] + at[self.pairs[level, 1]]
        return np.add.reduceat(at[self.parts], self.starts, axis=0)


def mine(items: list[list[bytes]]) -> Graph:
    """The graph of items with a term each at least. A term's further occurrences in an item are nodes beside the first."""
    names = sorted({t for item in items for t in item})
    leaf = {t: i for i, t in enumerate(names)}
    # (leaf, occurrence): sets hold repeats this way
    sets = [{(leaf[t], j) for t, n in Counter(item).items() for j in range(n)} for item in items]
    node = {x: x[0] for s in sets for x in s}  # what computes it
    made: dict[tuple[int, int], int] = {}
    copies: Counter = Counter()  # names of a made node: an item may hold it more than once
    changed = True
    while changed:
        changed = False
        holders: dict[tuple[int, int], set[int]] = {}
        for i, s in enumerate(sets):
            for x in s:
                holders.setdefault(x, set()).add(i)
        rank = {x: (-len(h), x) for x, h in holders.items()}
        count: Counter = Counter()
        for s in sets:
            shared = sorted((x for x in s if len(holders[x]) > 1), key=rank.__getitem__)
            count.update((a, b) if a < b else (b, a) for k, a in enumerate(shared) for b in shared[k + 1 : k + 1 + NEAR])
        for (a, b), n in sorted(count.items(), key=lambda x: (-x[1], x[0])):
            if n < 2:
                break
            both = holders[a] & holders[b]
            if len(both) < 2:
                continue
            both_nodes = tuple(sorted((node[a], node[b])))
            new = made.setdefault(both_nodes, len(names) + len(made))
            name = (new, copies[new])
            copies[new] += 1
            node[name] = new
            changed = True
            holders[name] = set()
            for i in both:
                sets[i] -= {a, b}
                sets[i].add(name)
                holders[a].discard(i), holders[b].discard(i)
                holders[name].add(i)
    pairs = np.array(list(made), np.int64).reshape(-1, 2)
    depth = np.zeros(len(names) + len(pairs), np.int64)
    for k, (a, b) in enumerate(pairs):
        depth[len(names) + k] = 1 + max(depth[a], depth[b])
    own = depth[len(names) :]
    levels = [np.flatnonzero(own == d) for d in range(1, 1 + own.max(initial=0))]
    parts = [sorted(node[x] for x in s) for s in sets]
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    return Graph(leaf, pairs, levels, np.array([x for p in parts for x in p], np.int64), starts)


def blocks(docs: DataFrame, graph: Graph, rows: int) -> DataFrame:
    """Packed blocks of `rows` documents: ids, which are null, terms of each, and (term, times) of the graph's terms."""
    known = docs.sparkSession.sparkContext.broadcast(graph.terms)  # at most BATCH_BYTES of terms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaf = known.value
        for batch in batches:
            for lo in range(0, len(batch), rows):
                part = batch.iloc[lo : lo + rows]
                lengths, sizes, leaves, times = [], [], [], []
                for raw in part["raw"]:
                    found = terms(raw)
                    held = Counter(map(leaf.get, found))
                    held.pop(None, None)
                    lengths.append(len(found))
                    sizes.append(len(held))
                    leaves += held.keys()
                    times += held.values()
                null = part["doc_id"].isna()
                ids = part["doc_id"].fillna("0").astype("int64").to_numpy().view(np.uint64)
                yield pd.DataFrame([(pack(ids, null, lengths, sizes, leaves, times),)], columns=["body"])

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), utf8("text")).mapInPandas(run, "body binary")


def statistics(packed: DataFrame) -> tuple[dict[int, int], int, int]:
    """(documents of each leaf, documents with a term, all terms)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Counter = Counter()
        for batch in batches:
            for body in batch["body"]:
                _, _, lengths, _, leaves, _ = unpack(body)
                at, n = np.unique(leaves, return_counts=True)
                sums.update(dict(zip(at.tolist(), n.tolist(), strict=True)))
                sums.update({-1: int((lengths > 0).sum()), -2: int(lengths.sum())})
        yield pd.DataFrame({"leaf": list(sums.keys()), "n": list(sums.values())}, dtype="int64")

    sums = {r.leaf: r.n for r in packed.mapInPandas(run, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect()}  # a row for each leaf of the graph
    return sums, sums.get(-1, 0), sums.get(-2, 0)


def best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of each item: highest score, then smallest id, null last."""
    found = found.sort_values(["item", "score", "null", "doc_id"], ascending=[True, False, True, True], ignore_index=True)
    return found[found.groupby("item").cumcount() < k]


def ranked(packed: DataFrame, graph: Graph, numbers: list[int], weights: np.ndarray, docs: int, words: int, k: int) -> DataFrame:
    """item, doc_id, score: the best k of every task. numbers: the items' own; weights: of the leaves."""
    held = packed.sparkSession.sparkContext.broadcast((graph, np.array(numbers), weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph, numbers, weights = held.value
        bar = np.zeros(len(numbers), np.int64)  # scores below can't be among the best any more
        kept, waiting = [pd.DataFrame({"item": [], "doc_id": [], "null": [], "score": []}, dtype="int64")], 0

        def settle() -> None:
            nonlocal waiting
            top = best(pd.concat(kept, ignore_index=True), k)
            full = top.groupby("item")["score"].agg(["size", "min"])
            full = full[full["size"] == k]
            bar[full.index.to_numpy(np.int64)] = full["min"].to_numpy()
            kept[:] = [top]
            waiting = 0

        for batch in batches:
            for body in batch["body"]:
                ids, null, lengths, sizes, leaves, times = (x.astype(np.int64) for x in unpack(body))
                doc = np.repeat(np.arange(len(ids)), sizes)
                m = 100 - 25 + (25 * lengths * docs) // max(words, 1)
                scores = np.zeros((len(graph.terms), len(ids)), np.int64)
                scores[leaves, doc] = weights[leaves] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
                scores = graph.combine(scores)
                i, d = np.nonzero((scores > 0) & (scores >= bar[:, None]))
                kept.append(pd.DataFrame({"item": i, "doc_id": ids[d], "null": null[d], "score": scores[i, d]}))
                waiting += len(i)
                if waiting >= HELD:
                    settle()
        settle()
        top = kept[0]
        ids = top["doc_id"].astype("Int64").mask(top["null"] == 1)
        yield pd.DataFrame({"item": numbers[top["item"].to_numpy(np.int64)], "doc_id": ids, "score": top["score"]})

    return packed.mapInPandas(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 of every item.

    docs: doc_id, text; items: item_id, text. Documents are packed under the shared folder, and results written there.
    """
    spark = docs.sparkSession
    small_batches(spark)
    where = place(spark, "lexical")
    asks = items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id())
    asks = stored(asks, f"{where}/items")
    batches = max(1, -(-(asks.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // batch_bytes))
    out = None
    for b in range(batches):
        own = asks.filter(F.pmod(F.xxhash64("item"), F.lit(batches)) == b)
        few = sorted((r.item, t) for r in own.select("item", utf8("text")).collect() if (t := terms(bytes(r.raw))))  # a batch of the stated query set
        if not few:
            continue
        graph = mine([t for _, t in few])
        packed = stored(blocks(docs, graph, max(1, BLOCK_CELLS // len(graph))), f"{where}/{b}-packed")
        df, n, length = statistics(packed)
        seen = np.array([df.get(leaf, 0) for leaf in range(len(graph.terms))])
        weights = np.floor(1000 * np.log((2 * n + 2) / (2 * seen + 1))).astype(np.int64)
        top = stored(ranked(packed, graph, [i for i, _ in few], weights, n, length, k), f"{where}/{b}-top")
        discard(spark, f"{where}/{b}-packed")
        out = top if out is None else out.unionByName(top)
    if out is None:
        return asks.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return out.join(asks.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


#: search() with its defaults in SQL, over all pairs of items and documents that share a term.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), b AS MATERIALIZED (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), q AS MATERIALIZED (
  SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM b) GROUP BY ALL
), s AS (
  SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d
), m AS (
  SELECT r, doc_id, 100 - 25 + ((25 * CAST(len(w) AS BIGINT) * n) // greatest(l, 1)) AS m FROM d, s
), t AS MATERIALIZED (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), v AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s
), p AS (
  SELECT q.item, q.item_id, m.r, m.doc_id, CAST(sum(q.times * v.weight * ((1000000000 * t.tf) // (1000 * t.tf + 12 * m.m))) AS BIGINT) AS score
  FROM q JOIN v USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY ALL
), o AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20
"""
