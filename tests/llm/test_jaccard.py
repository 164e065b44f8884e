"""The similarity join against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest

from lotwise.llm import jaccard
from lotwise.operators.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def sets_of(rows):
    out = []
    for doc_id, text in rows:
        w = WORD.findall(folded(text or ""))
        out.append((doc_id, frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows):
    sets = sets_of(rows)
    name = {d: d for d, _ in sets if d is not None}

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y:
                both = len(x & y)
                if 100 * both >= 85 * (len(x) + len(y) - both):
                    p, q = sorted((top(a), top(b)))
                    name[q] = p
    return sorted(((-1 if d is None else d), len(s), -1 if d is None else top(d)) for d, s in sets)


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


def near_copies(seed):
    """Families of copies with edits around the threshold, of many sizes."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, k = [], 0
    for size in (1, 3, 4, 5, 8, 9, 12, 20, 33, 60, 150, 400):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for _ in range(9):
                w = list(base)
                for _ in range(rng.choice([0, 0, 1, 1, 2, 3, max(1, size // 40), max(1, size // 25)])):
                    at = rng.randrange(len(w) + 1)
                    kind = rng.random()
                    if kind < 0.4 and w:
                        w[at % len(w)] = word()
                    elif kind < 0.7:
                        w.insert(at, word())
                    elif len(w) > 1:
                        del w[at % len(w)]
                rows.append((k, " ".join(w)))
                k += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_families_around_the_threshold(spark, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jaccard.resolve(df)) == brute(rows)


def test_whole_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(jaccard.resolve(docs)) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_one_large_family_of_near_copies(spark):
    """300 copies around the threshold: some near their hub, some far from it and near each other only."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(150)]
    far = list(base)
    for at in range(0, 150, 20):
        far[at] = word()
    rows = [(0, " ".join(base))]
    for k in range(1, 300):
        w = list(far if k % 3 == 0 else base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
            w[rng.randrange(150)] = word()
        rows.append((k, " ".join(w)))
    rng.shuffle(rows)
    assert got(jaccard.resolve(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))) == brute(rows)


def test_one_id_with_several_texts_is_linked_through_each(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for k in range(12):
        one, two = [word() for _ in range(60)], [word() for _ in range(60)]
        rows += [(1000 + k, " ".join(one)), (1000 + k, " ".join(two)), (k, " ".join(one[:-1])), (100 + k, " ".join(two[1:])), (1000 + k, " ".join(two).upper())]
    for parts in (1, 7):
        out = jaccard.resolve(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        assert {(r.doc_id, r.component_id) for r in out} == {(d, d % 100 if d < 1000 else d - 1000) for d, _ in rows}


def test_a_chunk_lists_the_followers_of_its_keys(spark, monkeypatch):
    rows = near_copies(5)
    monkeypatch.setattr(jaccard, "CHUNK_KEYS", 400)
    assert got(jaccard.resolve(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))) == brute(rows)


def test_keys_are_looked_up_in_parts(spark):
    rows = near_copies(6)
    done = jaccard.sketch(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 4, 85).toPandas()
    sizes = []
    for p in range(jaccard.PARTS):
        keys = np.concatenate(list(done[f"keys{p}"])).astype(np.int64)
        assert (jaccard.part_of(keys) == p).all()
        assert (done[f"probes{p}"] <= done[f"keys{p}"].map(len)).all()
        sizes.append(len(keys))
    led = {k for p in range(jaccard.PARTS) for ks in done[f"keys{p}"] for k in ks}
    assert sum(sizes) == len(led)  # one entry for each key of the chunk
    assert max(sizes) < 1.2 * sum(sizes) / jaccard.PARTS


def test_sql_is_the_plain_join(sf):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.sql(jaccard.SQL).fetchall()) == brute(con.sql("SELECT doc_id, text FROM documents").fetchall())


def test_edges(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    assert got(jaccard.resolve(edges)) == brute(rows)
    assert jaccard.resolve(nothing).collect() == []
    kept = jaccard.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({d for d, _, c in brute(rows) if d == c and d >= 0})


def test_signatures_share_a_key_whenever_sets_are_similar():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 6, 7, 8, 10, 13, 25, 60, 300):
        for _ in range(40):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            gone, new = rng.integers(0, 1 + n // 8, 2)
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, new).astype(np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if 100 * both < 85 * (len(a) + len(b) - both):
                continue
            (ka, pa), (kb, pb) = jaccard.signature(a), jaccard.signature(b)
            assert set(ka[:pa]) & set(kb) or set(kb[:pb]) & set(ka)


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)]
    name = {}

    def top(x):
        while name.setdefault(x, x) != x:
            x = name[x]
        return x

    for a, b in links:
        p, q = sorted((top(a), top(b)))
        name[q] = p
    out = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {x: top(x) for x in {y for link in links if link[0] != link[1] for y in link}}
