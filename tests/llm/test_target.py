"""Quality classifier, lexical search and resampling, against brute force and held-out rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import classifier, lexical, resample

ITEM_SCHEMA = "item_id long, text string, doc_id string, score string"


@pytest.fixture(scope="module", params=["sf", "edges"])
def docs(request, spark, sf, edges):
    return spark.read.parquet(f"{sf}/documents.parquet") if request.param == "sf" else edges


@pytest.fixture(scope="module")
def items(spark, sf):
    own = [(100, "a b c d a b", "x", "y"), (101, "A b; c", None, None), (101, "tab sep", None, None), (102, None, None, None), (103, "", None, None), (None, "no id line", None, None), (104, "the idiot MIT license", None, None), (104, "the idiot MIT license", None, None), (105, "zzz nowhere", None, None), (106, "ß É Σίσυφος", None, None)]
    more = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text", F.lit("c").alias("doc_id"), F.lit("c").alias("score"))
    return spark.createDataFrame(own, ITEM_SCHEMA).unionByName(more)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_search(docs, items, k=20):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    tokens = [(i, Counter(w), len(w)) for i, t in docs for w in [pattern.findall(lower(t))]]
    n, total = sum(size > 0 for *_, size in tokens), sum(size for *_, size in tokens)
    df = Counter(t for _, c, _ in tokens for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c, size in tokens:
            m = 75 + 25 * size * n // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in pattern.findall(lower(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


@pytest.mark.parametrize("batch_bytes", [lexical.BATCH_BYTES, 300])
def test_search_is_brute_force(docs, items, batch_bytes):
    got = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(docs, items, batch_bytes=batch_bytes).collect())
    assert got == brute_search([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(r.item_id, r.text) for r in items.collect()])


def test_search_of_nothing(spark, nothing, items, edges):
    assert lexical.search(nothing, items).collect() == []
    assert lexical.search(edges, items.limit(0)).collect() == []


def test_graph_shares_sums():
    """Each item is the sum of its own terms, in fewer additions than one by one."""
    rng = np.random.default_rng(4)
    items = [[b"w%d" % i for i in rng.zipf(1.4, 30) % 200] for _ in range(60)] + [[b"x"], [b"y", b"y", b"y"]]
    graph = lexical.mine(items)
    leaves = rng.integers(0, 1000, (len(graph.terms), 9))
    want = np.stack([sum(leaves[graph.terms[t]] for t in item) for item in items])
    assert (graph.combine(leaves) == want).all()
    assert graph.additions() < 0.8 * sum(len(i) - 1 for i in items)


def test_tasks_drop_candidates_that_cannot_win(spark, monkeypatch):
    monkeypatch.setattr(lexical, "HELD", 40)
    monkeypatch.setattr(lexical, "BLOCK_CELLS", 60)
    rows = [(i, "a " * (i % 7) + "b " * (i % 5) + "c") for i in range(300)]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), spark.createDataFrame([(1, "a b"), (2, "b c a a")], "item_id long, text string")
    got = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(docs, items).collect())
    assert got == brute_search(rows, [(1, "a b"), (2, "b c a a")])


def brute_resample(docs, target, percent=25, buckets=10_000):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = pattern.findall(lower(text))
        return w, [zlib.crc32(f.encode()) % buckets for f in [*w, *map(" ".join, zip(w, w[1:], strict=False))]]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    rows = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize("percent", [25, 100, 1])
def test_resampling_is_brute_force(docs, items, percent):
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in resample.resample(docs, items, percent).collect())
    assert got == brute_resample([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [r.text for r in items.collect()], percent)


def test_resampling_with_ties_and_repeats(spark, items):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(i % 7 if i % 11 else None, text + " x" * (i % 3)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in resample.resample(docs, items).collect())
    assert got == brute_resample(rows, [r.text for r in items.collect()])


def test_resampling_of_nothing(nothing, items, edges):
    assert resample.resample(nothing, items).collect() == []
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in resample.resample(edges, items.limit(0)).collect())
    assert got == brute_resample([(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()], [])


@pytest.mark.parametrize("pivots", [1, 4])
def test_quickselect_finds_every_rank(spark, pivots):
    rows = spark.createDataFrame([(-(i % 5), i % 9 == 0, None if i % 9 == 0 else i % 4, 1, i) for i in range(40)], "neg long, nameless boolean, doc_id long, n_features long, row long").repartition(3)
    want = sorted((resample.order(r) for r in rows.collect()))
    for k in (1, 2, 20, 39, 40):
        assert resample.order(resample.kth_key(rows, k, pivots)) == want[k - 1]


@pytest.fixture(scope="module")
def judged(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    one = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return classifier.score(docs, labels).join(one, "doc_id").toPandas()


def test_quality_of_held_out_rows(judged):
    out = judged[judged["held_out"]]
    good, bad = out[out["quality"] == 1], out[out["quality"] == 0]
    assert good["predicted"].mean() >= 0.9 and bad["predicted"].mean() <= 0.2
    assert judged["score"].between(0, 1).all() and (judged["predicted"] == (judged["score"] >= 0.7)).all()


def test_quality_learns_from_its_fold_only(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    got = [{r.doc_id: r.score for r in classifier.score(docs, x).collect()} for x in (labels, turned)]
    assert got[0].keys() == got[1].keys() and all(abs(got[0][k] - got[1][k]) < 1e-9 for k in got[0])


def test_quality_of_edges(edges, labels, nothing):
    out = classifier.score(edges, labels).collect()
    assert len(out) == edges.count() and all(0 <= r.score <= 1 for r in out)
    assert all(r.score == 0.5 for r in classifier.score(edges, labels.limit(0)).collect())
    assert classifier.score(nothing, labels).collect() == []


def test_word_vectors_are_sums_of_neighbours(spark):
    texts = ["red fox red dog !! red", "fox dog", None, ""]
    got = classifier.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    places, signs = classifier.index_vectors()
    want = np.zeros((classifier.SLOTS, classifier.WIDTH))
    for text in texts:
        w = [classifier.slot(x) for x in classifier.WORDS.findall(text or "")]
        for i, a in enumerate(w):
            for j in range(max(0, i - classifier.WINDOW), min(len(w), i + classifier.WINDOW + 1)):
                if i != j:
                    for p, s in zip(places[w[j]], signs, strict=True):
                        want[a, p] += s
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.abs(got - want).max() < 1e-6
