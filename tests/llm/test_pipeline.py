"""The pipeline's stages on a small table: what they keep, and that their decisions take effect."""

import importlib
import re

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lotwise.llm import bpe, jaccard, mixing, registry

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_in_a_row(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "ngram_jaccard":
            own = {r.doc_id for r in jaccard.resolve(before, 5, 80).filter("doc_id = component_id").select("doc_id").collect()}
            assert ids == own
        if name == "mixing_sources":
            want = {r.doc_id: r.taken for r in mixing.digest(before).collect() if r.taken}
            got: dict = {}
            for r in out.collect():
                got[r.doc_id] = got.get(r.doc_id, 0) + len(WORDS.findall(r.text))
            assert got == want
        before = out
    machine = bpe.load(registry.tokenizer_path())
    for r in before.limit(20).collect():
        assert bytes(r.ids) == machine.encode(r.text)[0] and r.n_tokens == len(np.frombuffer(r.ids, "<u4"))


def test_clean_documents_stay(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1"), "doc_id", "left_semi").count()
    kept = corpus_pipeline.language_id(spark, docs, sf)
    again = kept.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1"), "doc_id", "left_semi").count()
    assert again >= 0.99 * good


CLASHING = "q kept stratum document p size runs at pass k row digest ids n_tokens decoded component node label hub key __p __w".split()


def test_stages_take_edge_rows(spark, sf, edges, nothing, tmp_path):
    """Nulls, long texts, repeats, empty tables and columns with the stages' own names, through all five stages."""
    usual = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id > 20 AND doc_id < 60")
    for n, frame in enumerate((edges.unionByName(usual, allowMissingColumns=True), nothing)):
        docs = frame.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING if c not in frame.columns])
        columns = docs.columns
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / f"{n}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}-{name}"))
            own = [c for c in CLASHING if c in docs.columns and c not in ("ids", "n_tokens") and c not in frame.columns]
            assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
            assert docs.filter(" OR ".join(f"NOT `{c}` <=> concat('{c}:', doc_id)" for c in own)).isEmpty()
        assert n == 1 or docs.count() > 0


def test_all_eleven_are_registered():
    names = importlib.reload(entry).queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)) and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "ngram_jaccard", "mixing_sources", "bpe_encoding"]
