"""Top-k against brute force, and the language-model scores against plain counting."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import lm_score, topk


def brute_top(rows, k=20):
    vecs = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    vecs = sorted((i, tuple(v)) for i, v in vecs)
    out = []
    for q, x in sorted(set(vecs)):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), c) for c, y in vecs if c != q and len(y) == len(x))[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_top_k_over_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert got(topk.digest(rows)) == brute_top([(r.vec_id, r.embedding) for r in rows.collect()])


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [0.5, -0.25]), (1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [3.0]), (20, [-1.0, 2.0]), (7, [0.5, -0.25]), (8, [0.0, 0.0]), (20, [-1.0, 2.0]), (1, [0.25, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert got(topk.digest(df)) == brute_top(data)
    assert topk.digest(df.limit(0)).collect() == []


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_top_k_over_several_cells_with_ties(spark, spread):
    """Values with and without a few large components: with them the lists can be left early."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(600, 6)) * np.exp(spread * rng.normal(size=(600, 1))), 1)
    x[100:160] = x[7]
    data = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    out = topk.top_k(topk.integers(df), block_rows=170, batch=11)
    assert got(out) == brute_top(data)


def test_reading_stops_early_where_bounds_allow(spark):
    """With a few large components, most candidates are out before the lists end."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(4000, 8)) * np.exp(1.5 * rng.normal(size=(4000, 1))), 1)
    data = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    out = topk.top_k(topk.integers(spark.createDataFrame(data, "vec_id long, embedding array<double>")), block_rows=1000, batch=64).toPandas()
    assert sorted(zip(out.query_id, out["rank"], out.vec_id, out.score, strict=True)) == brute_top(data)
    assert out.depth.mean() < 0.7 and out.resolved.mean() < 125


def test_bounds_come_from_entries_read(monkeypatch):
    """After every step: sums and bounds of each query and row are those of the entries that the lists have shown, one by one."""
    rng = np.random.default_rng(8)
    x, q = rng.integers(-40, 40, (50, 5)).astype(float), rng.integers(-9, 9, (3, 5)).astype(float)
    lists = topk.Lists(x)
    reading = topk.Reading(lists, q)
    for step in range(len(topk.STEPS)):
        lower, upper = reading.advance()
        depth = lists.depth(step + 1)
        for i, v in enumerate(q):
            for c in range(len(x)):
                lo = hi = 0.0
                for d in range(5):
                    order = list(lists.rows[:, d]) if v[d] >= 0 else list(lists.rows[::-1, d])
                    shown = c in order[:depth]
                    lo += v[d] * (x[c, d] if shown else x[order[-1], d])
                    hi += v[d] * (x[c, d] if shown else x[order[depth - 1], d])
                assert lower[i, c] == lo and upper[i, c] == hi and lo <= v @ x[c] <= hi
    assert (lower == q @ x.T).all()


def test_blocks_under_the_bar_are_not_read(spark):
    """Blocks by length of the vectors: short ones can't reach the bar, and no query is sent to them."""
    rng = np.random.default_rng(3)
    x = rng.integers(1, 9, (900, 4))
    x[:300] *= 60
    data = [(i, [float(v) / 64 for v in row]) for i, row in enumerate(x)]
    df = topk.integers(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    out = topk.top_k(df, k=5, block_rows=300)
    assert got(out) == brute_top(data, 5)
    rows = df.select(F.size("v").alias("dim"), (F.col("vec_id") / 300).cast("int").alias("bl"), "v")
    box = {r.bl: r for r in topk.boxes(rows).collect()}
    assert all(list(box[b].high) == list(x[b * 300 : b * 300 + 300].max(axis=0)) and list(box[b].low) == list(x[b * 300 : b * 300 + 300].min(axis=0)) for b in range(3))
    query = spark.createDataFrame([([7, -2, 3, 1],)], "v array<long>").crossJoin(topk.boxes(rows)).select("bl", topk.most().alias("m")).collect()
    assert all(r.m >= (x[r.bl * 300 : r.bl * 300 + 300] @ [7, -2, 3, 1]).max() for r in query)


def plain_scores(rows, wanted):
    """Each text against models of all other texts; the background's counts scaled to the target's tokens."""
    tokens = {k: (t or "").encode().lower().split() for k, (_, t) in enumerate(rows)}
    count = Counter(w for ws in tokens.values() for w in ws)
    known = {w for w, n in count.items() if n >= 2}
    size = len(known) + 2
    named = {k: [w if w in known else 1 for w in ws] for k, ws in tokens.items()}

    def counts(keys):
        uni, hist, bi = Counter(), Counter(), Counter()
        for k in keys:
            for h, w in zip([0, *named[k]], named[k], strict=False):
                uni[w] += 1
                hist[h] += 1
                bi[h, w] += 1
        return uni, hist, bi

    wanted_keys = [k for k, (i, _) in enumerate(rows) if i in wanted]
    models = {"target": counts(wanted_keys), "background": counts(list(named))}
    tokens_of = {m: sum(c[0].values()) for m, c in models.items()}
    out = []
    for k, (i, _) in enumerate(rows):
        mine = counts([k])
        n = len(named[k])

        def loss(m, h, w):
            out_of_it = mine if m == "background" or k in wanted_keys else (Counter(),) * 3  # noqa: B023
            uni, hist, bi = ((lambda x, a=a, b=b: a[x] - b[x]) for a, b in zip(models[m], out_of_it, strict=True))
            scale = 1.0 if m == "target" else min(1.0, tokens_of["target"] / max(1.0, tokens_of[m]))
            total = scale * (tokens_of[m] - sum(out_of_it[0].values()))
            return -math.log2((scale * bi((h, w)) + 64 * (scale * uni(w) + 1) / (total + size)) / (scale * hist(h) + 64))

        pairs = list(zip([0, *named[k][:-1]], named[k], strict=True)) if n else []
        out.append((i, n, sum(loss("target", *p) - loss("background", *p) for p in pairs) / n if n else None))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] or 0.0)


def test_scores_are_the_plain_ones(spark, sf, edges):
    for docs, wanted in ((spark.read.parquet(f"{sf}/documents.parquet"), set(range(1, 200, 3))), (edges, {5, 8}), (edges, set())):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        fixed = spark.createDataFrame(rows, "doc_id long, text string")
        out = lm_score.score(fixed, spark.createDataFrame([(i,) for i in wanted], "doc_id long"))
        have = sorted([(r.doc_id, r.n_tokens, r.score) for r in out.collect()], key=key)
        want = sorted(plain_scores(rows, wanted), key=key)
        for a, b in zip(have, want, strict=True):
            assert a[:2] == b[:2] and (a[2] is None) == (b[2] is None)
            assert a[2] is None or abs(a[2] - b[2]) < 1e-6


def test_target_documents_score_lower(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    german = docs.filter("lang = 'de' AND doc_id % 2 = 0").select("doc_id")
    out = lm_score.score(docs, german).join(docs.filter("doc_id % 2 = 1").select("doc_id", "lang"), "doc_id")
    mean = {r.lang: r.m for r in out.groupBy("lang").agg(F.avg("score").alias("m")).collect()}
    assert mean["de"] == min(mean.values()) and mean["de"] < 0


def test_every_word_and_bigram_is_counted(spark):
    """More words than 2^16 and about 2^18 bigrams: no word is cut off, no two bigrams share a count."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 70_000, 2_000)) for _ in range(130)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:3]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = {1, 5, 131}
    out = lm_score.score(docs, spark.createDataFrame([(i,) for i in wanted], "doc_id long"))
    for a, b in zip(sorted((r.doc_id, r.n_tokens, r.score) for r in out.collect()), sorted(plain_scores(rows, wanted)), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9


def test_documents_that_occur_twice_stand_apart(spark):
    """A text whose copy is in the corpus is known to the background, which texts that occur once are not."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter(F.length("text") > 400).select("doc_id", "text")
    good = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id")
    twice = docs.join(good, "doc_id", "left_anti").filter("doc_id % 25 = 7").select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text")
    out = lm_score.score(docs.unionByName(twice), good).toPandas().set_index("doc_id")["score"]
    planted = out[[i for i in out.index if i >= 1_000_000]]
    others = out[[i for i in out.index if i < 1_000_000 and i + 1_000_000 not in out.index]]
    assert len(planted) > 15 and (planted > others.quantile(0.75)).mean() > 0.9


def test_buckets_follow_the_input(spark, sf):
    """Small and large buckets, and any session setting, give the same scores; a bucket holds a bounded part."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = labels.filter("quality = 1").select("doc_id")
    out = []
    for size, partitions in ((lm_score.BUCKET_BYTES, "4"), (20_000, "4"), (20_000, "13")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        out.append({r.doc_id: r.score for r in lm_score.score(docs, good, size).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(o.keys() == out[0].keys() and all(abs((o[k] or 0) - (v or 0)) < 1e-9 for k, v in out[0].items()) for o in out)
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 50_000).astype(np.uint64) * np.uint64(2))
    made = lm_score.asked(7, keys, 64, 0, np.ones(len(keys)))
    assert len(made) == 64 and max(len(lm_score.unpack_keys(*lm_score.unpack(b))) for b in made["body"]) < 2 * len(keys) / 64
    assert list(lm_score.asked(7, keys[:1], 64, 0, np.ones(1))["bucket"]) == [0]  # no row without a key


def test_lm_empty(spark, nothing, labels):
    assert lm_score.digest(nothing, labels).collect() == []
