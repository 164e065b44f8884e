"""Jaccard self-join of n-gram sets by partitioning the universe (pigeonhole).

Sets are put into size bands. The tokens of a band are hashed into m segments.
Two sets with similarity of at least t differ in at most H tokens, so if a set
gives its segments allowances v of 0 (skipped), 1 (equal) or 2 (at most one
token more or less) that sum to H + 1, some segment of a partner has fewer
differences than its allowance. Every set indexes its segments, and one-token
deletions of the few `wide` segments; it probes with the cheapest allowances
that reach the sum. The expected length of an index list falls with the number
of tokens in the segment, which is the cost: small and empty segments, that
unrelated sets share, are skipped first. Sets that share a key are verified on
their whole token sets.

Equal sets are one node, and keys with the same members are one group. Each
node is verified against the smallest node of its groups. Where a group is
still in several components, nodes with too many tokens that no other one has
drop out, and the rest is laid beside one hub, the middle of the group's
largest component. Differences from the hub decide everything else: two sets
differ where one difference holds an element and the other doesn't. Nodes near
the hub are linked with it, and two others can only be similar if their
differences share elements, so rare elements index them, and pairs that share
enough are verified by their differences. So thousands of copies cost a line
each, no pair list, and no link is lost.

Tokens are 64-bit hashes of word n-grams, in the index and in the verification.

Defined results: a text without words has an empty set and no link; a text
with fewer than n words has its whole sequence as one token; texts of any
length count whole (8 bytes a word); rows with a null id take no part
(component null); rows with one id are one document, linked through each of
its texts; repeated rows and ties get equal results, the smallest id naming
the component; an empty table gives no rows; further columns, whatever their
names, are not read, and keep_one() returns them unchanged.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.text import small_batches
from lotwise.operators.components import components
from lotwise.session import cut, discard, empty, place, stored

N = 4
PERCENT = 85
BAND = 1.25  # upper over lower size of a band
CACHE_WORDS = 300_000
LOCAL_COPIES = 1_000_000  # set digests a task remembers to drop the copies it has seen
CHUNK_KEYS = 1_000_000  # keys that a chunk holds at once
PARTS = 4  # keys are looked up in so many steps, by range, so that one part's shuffle is on disk at a time
PRUNINGS = 2

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


class Numbers(dict):
    """word -> 64-bit hash; forgets everything when full, never keeps long words."""

    def __init__(self) -> None:
        import xxhash

        super().__init__()
        self.hash = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        got = self.hash(word)
        if len(word) < 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""

    def __init__(self, n: int = N) -> None:
        self.n, self.known = n, Numbers()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII blanks only
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.n:
            return np.array([self.known.hash(b" ".join(words), seed=len(words))], np.uint64)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            s = sum(h[i : len(h) - self.n + 1 + i] * ODD[i % 6] for i in range(self.n))
        return distinct(mixed(s))


@functools.lru_cache(maxsize=None)
def bands(limit: int) -> list[tuple[int, int]]:
    """(smallest, largest size) of the bands up to the one that holds `limit`."""
    out, lo = [], 1
    while not out or out[-1][1] < limit:
        hi = max(lo, math.ceil(lo * BAND) - 1)
        out.append((lo, hi))
        lo = hi + 1
    return out


BANDS = bands(1 << 31)
STARTS = np.array([lo for lo, _ in BANDS])


def differ(a: int, b: int, percent: int) -> int:
    """Most tokens in which sets of a and b tokens may differ when they are similar enough."""
    return (100 - percent) * (a + b) // (100 + percent)


@functools.lru_cache(maxsize=None)
def layout(band: int, percent: int) -> tuple[int, int]:
    """(segments, wide ones) of a band: the cheapest that any prober's sum fits in."""
    lo, hi = BANDS[band]
    need = differ(hi, hi * 100 // percent, percent) + 1
    slack = need // 12
    best = None
    for wide in range(0, min(8, need // 2) + 1):
        m = max(1, need + slack - wide)
        if wide > m:
            continue
        size = lo / m
        cost = m + 2 * wide * size + 30 * m * math.exp(-size)  # entries, and lists that unrelated sets share
        if best is None or cost < best[0]:
            best = (cost, m, wide)
    return best[1], best[2]


def segments(tokens: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment of each token; tokens in each segment; sum of their hashes (0: empty)."""
    seg = ((tokens >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
    low = np.bincount(seg, (tokens & np.uint64(0xFFFFFFFF)).astype(float), m).astype(np.uint64)
    high = np.bincount(seg, (tokens >> np.uint64(32)).astype(float), m).astype(np.uint64)
    return seg, np.bincount(seg, minlength=m), low + (high << np.uint64(32))


def keyed(sums: np.ndarray, band: int, seg: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(sums * ODD[0] + np.uint64(band) * ODD[1] + seg.astype(np.uint64) * ODD[2] + np.uint64(kind) * ODD[3])


def signature(tokens: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """Keys of a set, those it probes with first, and how many these are."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64), 0
    own = int(np.searchsorted(STARTS, n, "right")) - 1
    probes, index = [], []
    band = own
    with np.errstate(over="ignore"):
        while band >= 0 and (band == own or BANDS[band][1] * 100 >= percent * n):
            m, wide = layout(band, percent)
            seg, many, sums = segments(tokens, m)
            at = np.arange(m)
            equal = keyed(sums, band, at, 0)
            holder = seg < wide
            shorter = sums[seg[holder]] - tokens[holder]
            dropped = seg[holder]
            # allowances: the cheapest units that make up the sum; the second unit of a wide segment widens it
            need = differ(n, min(n, BANDS[band][1]), percent) + 1
            cost = np.concatenate([np.exp(-many), (many[:wide] + 2.0) * np.exp(-(many[:wide] - 1.0))])
            units = np.argsort(cost, kind="stable")[:need]
            v = np.zeros(m, np.int64)
            np.add.at(v, np.where(units < m, units, units - m), 1)
            probes.append(equal[v > 0])
            two = v[dropped] == 2
            probes.append(keyed(shorter[two], band, dropped[two], 0))
            probes.append(keyed(sums[:wide], band, at[:wide], 1)[v[:wide] == 2])
            if band == own:
                index.append(equal[v == 0])
                index.append(keyed(shorter, band, dropped, 1))
            band -= 1
    ask = distinct(np.concatenate(probes))
    rest = np.setdiff1d(distinct(np.concatenate(index)), ask, assume_unique=True)
    return np.concatenate([ask, rest]).view(np.int64), len(ask)


def part_of(keys: np.ndarray) -> np.ndarray:
    """0 to PARTS - 1, by the keys' highest bits."""
    return (keys.view(np.uint64) >> np.uint64(32)) * np.uint64(PARTS) >> np.uint64(32)


def sketch(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """A row for each document: doc_id, row (a number of its own), n_shingles, digest of the set, for each part of the keys keys0...
    (the first probes0... are asked) and crowd0..., and follows.

    Copies that the task has seen get no keys. Within a chunk, the first set with a key stands for all that have it: the
    others list the key and that set's row in `follows`, and `crowd` sums their hashes. So a key of many sets is one entry
    a chunk, wherever it is looked up.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        shingle, seen, rows, waiting = Shingler(n), set(), [], 0
        number = TaskContext.get().partitionId() << 33

        def flush() -> pd.DataFrame:
            keys = np.concatenate([r[4] for r in rows])
            at = np.repeat(np.arange(len(rows)), [len(r[4]) for r in rows])
            ask = np.concatenate([np.arange(len(r[4])) < r[5] for r in rows])
            names = np.array([r[1] for r in rows], np.int64)
            order = np.argsort(keys, kind="stable")  # equal keys stay in the order of documents
            keys, at, ask = keys[order], at[order], ask[order]
            lead = np.ones(len(keys), bool)
            lead[1:] = keys[1:] != keys[:-1]
            starts, late = np.flatnonzero(lead), np.flatnonzero(~lead)
            crowd, asked = np.zeros(len(starts), np.int64), ask[starts]
            run = np.cumsum(lead)[late] - 1
            with np.errstate(over="ignore"):
                np.add.at(crowd, run, (mixed(names[at[late]].view(np.uint64)) >> np.uint64(34)).astype(np.int64) + 1)
            asked[run[ask[late]]] = True
            by = np.lexsort((~asked, at[starts]))  # by document, the asked keys first
            part = part_of(keys[starts])[by]
            late_by = np.argsort(at[late], kind="stable")
            follows = np.stack([keys[late], names[at[starts]][run]], 1)[late_by]
            stops = np.searchsorted(at[late][late_by], np.arange(len(rows) + 1))
            out = {
                "doc_id": pd.array([r[0] for r in rows], "Int64"), "row": names, "n_shingles": [r[2] for r in rows], "digest": [r[3] for r in rows],
                "follows": [follows[lo:hi].ravel() for lo, hi in zip(stops[:-1], stops[1:], strict=True)],
            }
            for p in range(PARTS):
                here = by[part == p]
                holder, led, many = at[starts][here], keys[starts][here], crowd[here]
                ends = np.searchsorted(holder, np.arange(len(rows) + 1))
                crowded = np.bincount(holder, many > 0, len(rows)) > 0
                out[f"probes{p}"] = np.bincount(holder, asked[here], len(rows)).astype(int)
                out[f"keys{p}"] = [led[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
                out[f"crowd{p}"] = [many[lo:hi] if c else None for lo, hi, c in zip(ends[:-1], ends[1:], crowded, strict=True)]
            rows.clear()
            return pd.DataFrame(out)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens = shingle(text)
                digest = xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None
                keys, ask = np.zeros(0, np.int64), 0
                if not pd.isna(doc_id) and digest is not None and digest not in seen:
                    if len(seen) >= LOCAL_COPIES:
                        seen.clear()
                    seen.add(digest)
                    keys, ask = signature(tokens, percent)
                rows.append((doc_id, number, len(tokens), digest, keys, ask))
                number, waiting = number + 1, waiting + len(keys)
            if waiting >= CHUNK_KEYS or len(rows) >= CHUNK_KEYS // 8:
                yield flush()
                waiting = 0
        if rows:
            yield flush()

    parts = "".join(f", probes{p} int, keys{p} array<long>, crowd{p} array<long>" for p in range(PARTS))
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id long, row long, n_shingles long, digest binary, follows array<long>{parts}")


def shared(done: DataFrame, p: int) -> DataFrame:
    """key, row, gid, led (whether others follow the row) of the sets that share an asked key of part p with others."""
    at = F.posexplode(f"keys{p}").alias("at", "key")
    entries = done.filter(F.size(f"keys{p}") > 0).select("row", F.col(f"probes{p}").alias("probes"), F.col(f"crowd{p}").alias("crowd"), at)
    entries = entries.select("key", (2 * F.col("row") + (F.col("at") < F.col("probes")).cast("int")).alias("row2"), F.coalesce(F.get("crowd", F.col("at")), F.lit(0)).alias("crowd"))
    w = W.partitionBy("key")  # a row a chunk at most
    seen = entries.withColumns({
        "lo": F.min("row2").over(w), "hi": F.max("row2").over(w), "asked": F.max(F.col("row2") % 2).over(w), "crowds": F.max("crowd").over(w),
        "sum": F.sum(F.xxhash64(F.shiftright("row2", 1)) % 1_000_000_007 + F.col("crowd")).over(w), "many": F.count("*").over(w),
    })
    row = F.shiftright("row2", 1).alias("row")
    return seen.filter("asked = 1 AND (lo < hi OR crowds > 0)").select("key", row, F.xxhash64(F.shiftright("lo", 1), F.shiftright("hi", 1), "many", "sum").alias("gid"), (F.col("crowd") > 0).alias("led"))


def shared_keys(done: DataFrame, where: str) -> DataFrame:
    """gid, row of the sets that share an asked key with others; keys with the same members have one gid. Reads what it writes to `where`."""
    # a row for each shared key: compressed, and gone with the sketch
    seen = functools.reduce(DataFrame.unionByName, [stored(shared(done, p), f"{where}/{p}") for p in range(PARTS)])
    follows = done.filter(F.size("follows") > 0).select("row", F.explode(F.expr("transform(sequence(0, size(follows) div 2 - 1), i -> struct(follows[2 * i] AS key, follows[2 * i + 1] AS lead))")).alias("f"))
    crowd = follows.select("f.key", "f.lead", "row").join(seen.filter("led").select("key", F.col("row").alias("lead"), "gid"), ["key", "lead"]).select("gid", "row")
    return seen.select("gid", "row").unionByName(crowd).distinct()


def most(a: Column, b: Column, percent: int) -> Column:
    """differ() of two sizes."""
    return F.floor((100 - percent) * (a + b) / (100 + percent))


def token_sets(docs: DataFrame, wanted: DataFrame, n: int, repeated: bool, where: str) -> DataFrame:
    """node, tokens, written to `where`. wanted: node, doc_id and digest of the set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        shingle = Shingler(n)
        for batch in batches:
            out = []
            for node, digest, text in zip(batch["node"], batch["digest"], batch["text"], strict=True):
                tokens = shingle(text)
                if len(tokens) and xxhash.xxh3_128_digest(tokens.tobytes()) == digest:  # else another text of that id
                    out.append((node, tokens.view(np.int64)))
            yield pd.DataFrame(out, columns=["node", "tokens"])

    found = docs.join(wanted, "doc_id").select("node", "digest", "text").mapInPandas(run, "node long, tokens array<long>")
    return stored(found.dropDuplicates(["node"]) if repeated else found, where)


def beside(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """pairs (node, hub) with the tokens of both, `t` and `h`."""
    mine = pairs.join(tokens.withColumnRenamed("tokens", "t"), "node")
    return mine.join(tokens.select(F.col("node").alias("hub"), F.col("tokens").alias("h")), "hub")


def split_groups(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The groups whose nodes belong to several components, with the nodes' labels."""
    marked = groups.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")) if labels is not None else groups
    split = marked.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("gid")
    return cut(marked.join(split, "gid", "left_semi").select("gid", "node", "size", "label"))


def without_loners(marked: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Drops nodes with more tokens of their own (that no other node here has) than similar sets may differ in; adds `own`."""
    for _ in range(PRUNINGS):
        nodes = marked.select("node", "size").distinct()
        held = tokens.join(nodes, "node", "left_semi").select("node", F.explode("tokens").alias("token"))
        once = held.groupBy("token").agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1")
        own = nodes.join(once.groupBy("node").agg(F.count("*").alias("own")), "node", "left").select("node", "size", F.coalesce("own", F.lit(0)).alias("own"))
        kept = own.filter(F.col("own") <= most(F.col("size"), F.floor(100 * F.col("size") / percent), percent)).select("node", "own")
        kept = cut(kept)
        marked = split_groups(marked.join(kept, "node", "left_semi"), None)
    return marked.join(kept, "node")


def to_hubs(marked: DataFrame) -> DataFrame:
    """hub, node: every node beside the hub of each of its groups, which stands for the group's largest component.

    A component's hub is its node with the fewest tokens of its own, the middle of a family of copies.
    """
    labels = marked.groupBy("label").agg(F.min(F.struct("own", -F.col("size"), "node")).alias("r"), F.approx_count_distinct("node").alias("many"))
    labels = labels.select("label", "many", F.col("r.node").alias("hub"))
    inside = marked.select("gid", "label").distinct().join(labels, "label")
    hubs = inside.groupBy("gid").agg(F.max_by("hub", F.struct("many", -F.col("label"))).alias("hub"))
    return marked.join(hubs, "gid").filter("node <> hub").select("hub", "node").distinct()


def candidates(family: DataFrame, percent: int) -> DataFrame:
    """Pairs x, y of a hub's family that may be similar, by shared elements of their differences from the hub.

    family: hub, size_h, node, size, label, far, more, less. Similar sets x and y, x too far from the hub to be similar to it,
    share c >= 1 elements of their differences. With elements in one order (rare ones first), the first that they share
    leaves at least c - 1 behind it in both, so the last c - 1 elements of y need no entry.
    """
    d = F.size("more") + F.size("less")
    element = F.explode(F.concat(F.transform("more", lambda e: F.struct(F.lit(1).alias("side"), e.alias("e"))), F.transform("less", lambda e: F.struct(F.lit(0).alias("side"), e.alias("e"))))).alias("s")
    rows = family.select("hub", "size_h", "node", "size", "label", "far", d.alias("d"), element).select("*", "s.side", "s.e").drop("s")
    held = rows.groupBy("hub", "side", "e").agg(F.count("*").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    rows = rows.join(held, ["hub", "side", "e"])
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("hub", "node").orderBy(F.col("lo") < F.col("hi"), "c", "side", "e")) - 1)
    ratio = (100 - percent) / (100 + percent)
    common = F.greatest(F.lit(1), F.ceil((F.col("d") + F.floor(ratio * (F.col("size_h") - F.col("size")) - 1e-9) + 1) / 2))
    rows = rows.filter("lo < hi").withColumn("early", F.col("rank") <= F.col("d") - common)
    side = lambda k: rows.select("hub", "side", "e", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "size", "label", "far", "d", "rank", "early")])
    x, y = side("x").filter("far_x"), side("y").filter("early_y")
    c = F.ceil((F.col("d_x") + F.col("d_y") - most(F.col("size_x"), F.col("size_y"), percent)) / 2)
    left = F.least(F.col("d_x") - F.col("rank_x"), F.col("d_y") - F.col("rank_y"))
    on = (x["hub"] == y["hub"]) & (x["side"] == y["side"]) & (x["e"] == y["e"]) & (F.col("label_x") != F.col("label_y")) & (left >= c)
    on = on & (~F.col("far_y") | (F.col("early_x") & (F.struct("d_x", "node_x") < F.struct("d_y", "node_y"))))
    on = on & (100 * F.least("size_x", "size_y") >= percent * F.greatest("size_x", "size_y"))
    return x.join(y, on).select(x["hub"], F.col("node_x").alias("x"), F.col("node_y").alias("y")).groupBy("x", "y").agg(F.min("hub").alias("hub"))


def linked(groups: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that make up the components. groups: gid, node, size."""
    # Each node beside the smallest node of most of its groups.
    centre = groups.groupBy("gid").agg(F.min(F.struct("node", "size")).alias("h"))
    votes = groups.join(centre, "gid").filter("node <> h.node").filter(100 * F.least("size", "h.size") >= percent * F.greatest("size", "h.size")).groupBy("node", F.col("h.node").alias("hub")).count()
    best = votes.groupBy("node").agg(F.max_by("hub", F.struct("count", -F.col("hub"))).alias("hub"))
    both = F.size(F.array_intersect("t", "h"))
    links = cut(beside(best, tokens).filter(100 * both >= percent * (F.size("t") + F.size("h") - both)).select(F.col("node").alias("a"), F.col("hub").alias("b")))
    # What is still in several components, beside one hub for each group.
    marked = split_groups(groups, components(links))
    if empty(marked):
        return links
    marked = cut(without_loners(marked, tokens, percent))
    family = beside(to_hubs(marked), tokens).select("hub", "node", F.size("h").alias("size_h"), F.size("t").alias("size"), F.array_except("t", "h").alias("more"), F.array_except("h", "t").alias("less"))
    family = cut(family.withColumn("far", F.size("more") + F.size("less") > most(F.col("size"), F.col("size_h"), percent)))
    links = cut(links.unionByName(family.filter("NOT far").select(F.col("node").alias("a"), F.col("hub").alias("b"))))
    # What two nodes far from or near their hub have in common beyond it.
    labels = cut(components(links))
    family = family.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    pairs = cut(candidates(family, percent))
    of = lambda k: family.select("hub", F.col("node").alias(k), F.col("size").alias(f"size_{k}"), F.col("more").alias(f"more_{k}"), F.col("less").alias(f"less_{k}"))
    full = pairs.join(of("x"), ["hub", "x"]).join(of("y"), ["hub", "y"])
    gap = sum(F.size(f"{p}_{k}") for p in ("more", "less") for k in "xy") - 2 * sum(F.size(F.array_intersect(f"{p}_x", f"{p}_y")) for p in ("more", "less"))
    found = full.filter(gap <= most(F.col("size_x"), F.col("size_y"), percent))
    return cut(links.unionByName(found.select(F.col("x").alias("a"), F.col("y").alias("b"))))


def resolve(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    where = place(docs.sparkSession, "jaccard")
    done = stored(sketch(docs, n, percent), f"{where}/sketch")
    base = cut(done.select("doc_id", "row", "n_shingles", "digest", (sum(F.size(f"keys{p}") for p in range(PARTS)) + F.size("follows") > 0).alias("keyed")))
    usable = base.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    repeated = not empty(usable.groupBy("doc_id").count().filter("count > 1"))
    # equal sets are one node: the first row that has it, and the smallest id
    nodes = cut(usable.groupBy("digest").agg(F.min("row").alias("node"), F.min_by("doc_id", "row").alias("doc_id"), F.max("n_shingles").alias("size"), F.min("doc_id").alias("least")))
    owner = base.filter("keyed").select("row", "digest").join(nodes, "digest").select("row", "node", "size")
    groups = cut(shared_keys(done, f"{where}/keys").join(owner, "row").select("gid", "node", "size").distinct())
    for name in ("sketch", "keys"):
        discard(docs.sparkSession, f"{where}/{name}")
    wanted = nodes.join(groups.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "digest")
    tokens = token_sets(docs, wanted, n, repeated, f"{where}/tokens")
    links = linked(groups, tokens, percent)
    discard(docs.sparkSession, where)
    labels = cut(components(links))
    named = nodes.join(labels, "node", "left").select("digest", "least", F.coalesce("label", "node").alias("label"))
    if repeated:  # one id with several sets joins their components
        ids = usable.join(named, "digest").groupBy("doc_id", "label").agg(F.lit(1)).select("doc_id", "label")
        joins = ids.join(ids.groupBy("doc_id").agg(F.min("label").alias("b")), "doc_id").select(F.col("label").alias("a"), "b").filter("a <> b")
        merged = components(joins).select(F.col("node").alias("label"), F.col("label").alias("whole"))
        named = named.join(merged, "label", "left").select("digest", "least", F.coalesce("whole", "label").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component"), F.count("*").alias("sets")).filter("sets > 1")
    named = named.join(least, "label", "left").select("digest", F.coalesce("component", "least").alias("component"))
    out = base.join(named, "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One document of each group: the one with the smallest id; rows with a null id stay."""
    found = cut(resolve(docs, n, percent).select("doc_id", "component_id").filter("doc_id IS NOT NULL"))
    extra = found.filter("doc_id <> component_id").select("doc_id").distinct()
    whole = docs.join(extra, "doc_id", "left_anti")
    if not empty(found.groupBy("doc_id").count().filter("count > 1")):  # repeated rows: one of each id
        whole = whole.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(whole.filter("doc_id IS NULL"))
    return whole.select(*[F.col(f"`{c}`") for c in docs.columns])


#: resolve() with its defaults in SQL, over all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d
), e AS MATERIALIZED (SELECT r, doc_id, len(g) AS n, unnest(g) AS g FROM s WHERE len(g) > 0),
l AS MATERIALIZED (
  SELECT DISTINCT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS nx, any_value(y.n) AS ny, count(*) AS shared FROM e x JOIN e y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r, x.doc_id, y.doc_id)
  WHERE 100 * shared >= 85 * (nx + ny - shared)
), reach AS (SELECT a AS node, a AS other FROM l UNION SELECT reach.node, l.b FROM reach JOIN l ON l.a = reach.other)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.first, s.doc_id)) AS component_id FROM s LEFT JOIN (SELECT node, min(other) AS first FROM reach GROUP BY node) m ON m.node = s.doc_id
"""
