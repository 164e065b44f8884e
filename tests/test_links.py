"""Links within a block against all pairs, and what resolution writes down on its way."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_resolution import ROW, closure, listing, near

from lotwise.functions.similarity import token_set
from lotwise.operators import edges, links, resolve


def clusters(n, table):
    return closure(range(n), zip(table["a"].to_pylist(), table["b"].to_pylist(), strict=True))


@pytest.mark.parametrize("seed", range(4))
def test_texts_of_a_block_against_all_pairs(seed):
    rng = random.Random(seed)
    for _ in range(20):
        words = ["".join(rng.choice("abc1é,") for _ in range(rng.randrange(1, rng.choice([4, 9, 80])))) for _ in range(6)]
        n, least = rng.randrange(1, 40), rng.choice([80, 90, 95])
        texts = [rng.choice([" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))), f"dlha ulica {rng.randrange(9999)} " + rng.choice(["rod", "ring"])]) for _ in range(n)]
        size = [round(rng.uniform(40, 44), 1) for _ in range(n)]
        own = [5 if s <= sorted(size)[n // 2] else 6 for s in size]
        block = pa.table({"text": texts, "size": size, "bucket": [round(s) for s in size], "own": own, "id": list(range(n))})
        want = [
            (a, b) for a, b in itertools.combinations(range(n), 2)
            if 5 in (own[a], own[b]) and near(size[a], size[b]) and abs(round(size[a]) - round(size[b])) <= 2 and token_set(texts[a], texts[b]) >= least
        ]
        assert clusters(n, links.alike(least, 0.03, 2)((None, None, pa.scalar(5)), block)) == closure(range(n), want)


def test_texts_that_are_linked_are_not_compared(monkeypatch):
    """3,000 texts that are all alike: some thousand comparisons, not 4.5 million."""
    seen, run = [], links.Texts.compared
    monkeypatch.setattr(links.Texts, "compared", lambda self, x, y, whole: (seen.append(len(x)), run(self, x, y, whole))[1])
    n = 3000
    block = pa.table({"text": [f"dlha ulica pekna budova {i}" for i in range(n)], "size": [50.0] * n, "bucket": [50] * n, "own": [5] * n, "id": list(range(n))})
    out = links.alike(90, 0.03, 2)((None, None, pa.scalar(5)), block)
    assert set(clusters(n, out).values()) == {0} and sum(seen) < 20 * n


def test_dense_places_give_an_edge_a_row():
    rng = random.Random(1)
    n = 3000
    block = pa.table({"lat": [48.1 + rng.random() * 0.002 for _ in range(n)], "lng": [17.1 + rng.random() * 0.002 for _ in range(n)], "size": [50 + rng.random() for _ in range(n)], "id": list(range(n))})
    out = links.near(60.0, 0.03)(block)
    assert set(clusters(n, out).values()) == {0} and out.num_rows == n - 1


def test_components_by_numbers_are_those_by_ids(spark):
    """Edges that are written down carry numbers, and rows of one id are one."""
    rows = [listing(i, photos=[f"p{i % 7}"] if i % 3 else [], listing_key=f"k{i // 2 % 9}", portal="ab"[i % 2]) for i in range(30)] + [listing(1, photos=["other"]), listing(40, photos=["other"])]
    df = spark.createDataFrame(rows, ROW)
    names = ("P1", "I1")
    found = resolve.rules(df, names=names)
    assert list(found) == ["P1", "I1"]
    want = {tuple(r) for r in resolve.label(df, resolve.union(found.values())).select("row_id", "cluster_id").collect()}
    assert {tuple(r) for r in resolve.labelled_by(df, names).select("row_id", "cluster_id").collect()} == want
    assert {f.dataType.simpleString() for e in resolve.rule_by_rule(resolve.numbered(df), names) for f in e.schema} == {"bigint"}


def test_small_clusters_are_gathered_before_they_are_aggregated(spark, monkeypatch):
    rows = [listing(i, price=float(i), rooms=i % 3, size=50.0 + i % 5, photos=[f"p{i}"], updated_at=f"2025-01-{i % 9 + 1:02d}") for i in range(24)]
    df = spark.createDataFrame(rows, ROW).withColumn("cluster_id", F.when(F.col("price") < 9, "big").otherwise(F.concat(F.lit("c"), (F.col("price") % 4).cast("string"))))
    want = {r.cluster_id: r for r in resolve.records(df).collect()}
    monkeypatch.setattr(resolve, "BIG", 6)
    got = resolve.golden(df)
    assert {r.cluster_id: r for r in got.collect()} == want
    assert "REPARTITION_BY_COL" in got._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_not_held_against_one_another(spark):
    """A pair that meets in several blocks comes out once, without a distinct over all pairs."""
    rows = [listing(i, listing_key="k", address="q", size=70.0 + i % 2, photos=["p", "o"]) for i in range(6)]
    found = edges.scored_pairs(spark.createDataFrame(rows, ROW))
    assert found.count() == 15
    top = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in top
