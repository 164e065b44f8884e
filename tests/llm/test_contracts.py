"""The numbered queries against plain Python, over whole small tables and edge rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from lotwise.llm import bpe, langid, license_scan, mixing, quality, registry, shards, toxicity

GAPS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["sf", "edges"])
def docs(request, spark, sf, edges):
    return spark.read.parquet(f"{sf}/documents.parquet") if request.param == "sf" else edges


def rows(df):
    return [r.asDict() for r in df.collect()]


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def test_bpe_is_the_library(docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(registry.tokenizer_path())
    lib.no_truncation(), lib.no_padding()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want[r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(bpe.digest(docs, registry.tokenizer_path())))
    assert got == want


def test_bpe_round_trip_of_labels():
    machine = bpe.load(registry.tokenizer_path())
    ids, decoded = machine.encode("the quick brown fox <|endoftext|> über 42")
    assert machine.decode(ids) == decoded


def test_automaton_matches_merging_by_rank():
    """Small random merge lists, against the definition."""
    rng = np.random.default_rng(3)
    for _ in range(60):
        vocab = {c: i for i, c in enumerate("ab")} | {c + "$": i + 2 for i, c in enumerate("ab")}
        merges = []
        for _ in range(8):
            a, b = (list(vocab)[i] for i in rng.integers(0, len(vocab), 2))
            if not a.endswith("$") and a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
        machine, rank = bpe.MergeAutomaton(vocab, merges, "$"), {m: i for i, m in enumerate(merges)}
        for _ in range(60):
            word = "".join("ab"[i] for i in rng.integers(0, 2, rng.integers(1, 12)))
            parts = [*word[:-1], word[-1] + "$"]
            while True:
                best = min((rank[p], i) for i, p in enumerate([*zip(parts, parts[1:], strict=False)]) if p in rank) if any(p in rank for p in zip(parts, parts[1:], strict=False)) else None
                if best is None:
                    break
                i = best[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert machine.encode(word) == [vocab[p] for p in parts]


def base_counts(text):
    words = GAPS.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if GAPS.search(x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed


def test_quality_counts(docs, labels, spark, sf):
    marks = labels if "shard" in docs.columns else spark.read.parquet(f"{sf}/labels.parquet")
    want = Counter((r.doc_id, *base_counts(r.text)) for r in docs.select("doc_id", "text").collect())
    out = rows(quality.judge(docs, marks))
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in out)
    assert got == want
    assert not any(r["kept"] and r["base_failed"] for r in out)


SHARES = "stratum string, good boolean, tuning boolean, symbols double, repeats double, lines double, capitals double"


def test_quality_cutoffs_are_certified(spark):
    """3000 good rows with shares up to 8 percent, 300 bad ones far above: the cutoff loses no more than risked."""
    data = [("=en", True, i % 4 == 0, float(i % 9), 0.0, 0.0, 0.0) for i in range(3000)] + [("=en", False, False, 45.0, 0.0, 0.0, 0.0)] * 300 + [("=xx", True, i == 0, 0.0, 0.0, 0.0, 0.0) for i in range(5)] + [("=xx", False, False, 99.0, 0.0, 0.0, 0.0)] * 5
    got = {r.stratum: r for r in quality.choose(spark.createDataFrame(data, SHARES)).collect()}
    assert list(got) == ["=en"]  # five good documents certify nothing
    assert 8 <= got["=en"].cut_symbols < 45 and got["=en"].cut_repeats is got["=en"].cut_lines is got["=en"].cut_capitals is None
    assert (got["=en"].good, got["=en"].lost) == (2250, 0)


def test_quality_guarantee_holds(spark):
    """Strata whose good and bad rows do not differ: of 300 of them, few may get a setting that loses more than risked."""
    rng = np.random.default_rng(8)
    data = []
    for k in range(300):
        for i in range(330):
            data.append((f"={k}", i >= 30, i % 4 == 0, *(float(x) for x in 100 * rng.beta(0.5, 8, 4))))
    got = quality.choose(spark.createDataFrame(data, SHARES)).collect()
    draws = 100 * rng.beta(0.5, 8, (100_000, 4))
    worse = sum((draws > [np.inf if r[f"cut_{x}"] is None else r[f"cut_{x}"] for x in quality.RULES]).any(1).mean() > quality.RISK for r in got)
    assert worse <= 2  # the chance of any at all is 0.05


def plain_kept(rows, marks):
    """kept, by the docstring, in plain Python."""
    from fractions import Fraction
    from math import comb

    def shares(text):
        n, chars, symbols, dup, repeat, failed = base_counts(text)
        lines = sum(1 for x in (text or "").split("\n") if GAPS.search(x))
        capitals = len(regex.findall(r"\p{Lu}", text or ""))
        part = lambda a, b: 100 * a / b if b else 0.0
        return failed, (part(symbols, chars), part(repeat, n), part(dup, lines), part(capitals, chars))

    good = {}
    for d, q in marks:
        if d is not None and q is not None:
            good[d] = good.get(d, True) and q == 1
    measured = [(d, lang, *shares(t)) for d, t, lang in rows]
    use = {}
    for d, lang, failed, s in measured:
        if not failed and d in good:
            use.setdefault(lang, []).append((good[d], crc(d) % quality.TUNING == 0, s))
    tested = {lang: sum(g and not t for g, t, _ in x) for lang, x in use.items()}
    able = max(1, sum((1 - quality.RISK) ** n <= quality.LEVEL for n in tested.values()))
    chosen = {}
    for lang, x in use.items():
        fold, bad, test = [s for g, t, s in x if g and t], [s for g, _, s in x if not g], [s for g, t, s in x if g and not t]
        best = None
        for step, (share, slack) in enumerate(quality.STEPS):
            cuts = []
            for r in range(4):
                lost = [sum(s[r] > c for s in fold) for c in quality.GRID]
                i = max((i for i, n in enumerate(lost) if n <= share * len(fold)), default=-99) - slack
                use_it = i >= 0 and sum(s[r] > quality.GRID[i] for s in bad) * max(1, len(fold)) > lost[i] * len(bad)
                cuts.append(quality.GRID[i] if use_it else math.inf)
            out = lambda s, cuts=cuts: any(a > c for a, c in zip(s, cuts, strict=True))
            n, k, hit = len(test), sum(map(out, test)), sum(map(out, bad))
            risk = Fraction(str(quality.RISK))
            if not n or k > n * risk or sum(comb(n, i) * float(risk**i * (1 - risk) ** (n - i)) for i in range(k + 1)) > quality.LEVEL / able:
                break
            gain = hit / len(bad) - k / n if bad else -k / n
            if hit and (best is None or gain > best[0]):
                best = gain, cuts
        chosen[lang] = best[1] if best else [math.inf] * 4
    return Counter((d, not failed and all(a <= c for a, c in zip(s, chosen.get(lang, [math.inf] * 4), strict=True))) for d, lang, failed, s in measured), chosen


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1"])
def test_quality_verdicts_are_the_plain_ones(spark, table):
    docs, marks = (spark.read.parquet(f"/root/testdata/{table}/{x}.parquet") for x in ("documents", "labels"))
    rows_ = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    want, chosen = plain_kept(rows_, [(r.doc_id, r.quality) for r in marks.collect()])
    out = quality.judge(docs, marks).cache()
    assert Counter((r.doc_id, r.kept) for r in out.collect()) == want
    if table == "sf0.1":  # every language with 300 good labels has rules, and they reject bad documents
        good = docs.join(marks.filter("quality = 1"), "doc_id").groupBy("lang").count().filter("count >= 300").collect()
        bad = out.join(marks.filter("quality = 0"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
        hit = {r.lang: r["count"] for r in bad.filter("NOT kept AND NOT base_failed").groupBy("lang").count().collect()}
        assert good and all(hit.get(r.lang, 0) > 0 for r in good), (hit, chosen)


def test_quality_keeps_clashing_columns(spark, labels):
    data = [(1, "en", "word " * 3 + " ".join(f"w{i}" for i in range(60)), "q!", "k!", 1.5, "s!", "d!", "t!")]
    names = ["doc_id", "lang", "text", "q", "kept", "cut_symbols", "stratum", "document", "__w"]
    df = spark.createDataFrame(data, names)
    assert [tuple(r) for r in quality.keep(df, labels).collect()] == data and quality.keep(df, labels).columns == names


def test_binomial_tail(spark):
    from math import comb

    for n, k, p in ((10, 0, 0.3), (200, 3, 0.05), (1000, 9, 0.02)):
        tail = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        cells = spark.createDataFrame([(n, k)], "n long, k long")
        assert quality.certified(cells, p, F.lit(tail * 1.0001)).first().holds
        assert not quality.certified(cells, p, F.lit(tail * 0.9999)).first().holds


def license_words(text):
    folded = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def test_license_base(docs):
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        w = license_words(r.text)
        hits = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(w)) if tuple(w[i : i + len(phrase)]) == phrase]
        at = [i for i, _ in hits]
        want[r.doc_id, len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))] += 1
    out = rows(license_scan.digest(docs))
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out) == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in out)


def test_license_texts_are_found(spark):
    body = dict(license_scan.TEMPLATES)
    broken = body["gpl-text"].split(" ")
    broken[12:12] = ["dear", "reader"]
    data = [(1, "x y z " + body["mit-text"] + " tail"), (2, " ".join(broken)), (3, body["apache-text"][:60]), (4, "clean words only " * 30)]
    got = {r["doc_id"]: r for r in rows(license_scan.scan(spark.createDataFrame(data, "doc_id long, text string")))}
    assert got[1]["template"] == "mit-text" and got[1]["first_word"] == 3
    assert got[2]["template"] == "gpl-text"
    assert 3 not in got and 4 not in got


def test_inserted_lines_keep_the_label(spark):
    """Words in the middle of a passage, anywhere; a second copy; no label for half a passage or for shuffled words."""
    body = dict(license_scan.TEMPLATES)
    rng = np.random.default_rng(1)
    data, want = [], {}
    for label in ("mit-text", "apache-text", "gpl-text", "bsd-text", "isc-text", "bsd-liability"):
        words = body[label].split(" ")
        for added in (1, 3, 7, 10):
            for at in (6, len(words) // 2, len(words) - 6):
                data.append((len(data), " ".join(["intro", *words[:at], *[f"line{i}" for i in range(added)], *words[at:], "end"])))
                want[len(data) - 1] = label
        broken = list(words)
        broken[2 * len(words) // 3 : 2 * len(words) // 3] = ["Copyright", "2024", "Somebody"]
        broken[len(words) // 3 : len(words) // 3] = ["which", "we", "like"]
        data.append((len(data), " ".join(broken)))
        want[len(data) - 1] = label
        data.append((len(data), " ".join([*words, *["between"] * 5, *words])))
        want[len(data) - 1] = label
        data.append((len(data), " ".join(words[: len(words) // 2])))
        data.append((len(data), " ".join(rng.permutation(words))))
    found = rows(license_scan.scan(spark.createDataFrame(data, "doc_id long, text string")))
    got: dict = {}
    for r in found:
        got.setdefault(r["doc_id"], set()).add(r["template"])
    assert {d for d, label in want.items() if label not in got.get(d, ())} == set()
    assert set(got) == set(want)
    assert max(Counter(r["doc_id"] for r in found if r["template"] == want[r["doc_id"]]).values()) == 2


def test_inserted_paragraphs_keep_the_label(spark):
    """Up to 60 words put into a passage; more than that, or another copy near by, is another stretch."""
    body = dict(license_scan.TEMPLATES)
    data, want = [], {}
    for label in ("mit-text", "gpl-warranty", "isc-text", "bsd-liability"):
        words = body[label].split(" ")
        for added in (10, 25, 40, 60 if len(words) >= 50 else 40):
            for at in (len(words) // 3, len(words) // 2):
                data.append((len(data), " ".join([*words[:at], *[f"line{i}" for i in range(added)], *words[at:]])))
                want[len(data) - 1] = label
        data.append((len(data), " ".join([*words[: len(words) // 2], *["far"] * 300, *words[len(words) // 2 :]])))
    found = rows(license_scan.scan(spark.createDataFrame(data, "doc_id long, text string")))
    assert {r["doc_id"]: r["template"] for r in found} == want


def test_shards(docs):
    out = rows(shards.digest(docs))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    by_shard = {}
    for r in out:
        assert r["law"] == "key" and 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    ids = docs.select("doc_id", F.lit(1).alias("text"))
    more = {r["doc_id"]: r["shard"] for r in rows(shards.assign(ids.withColumn("text", F.lit("")), 41))}
    assert all(more[r["doc_id"]] == r["grown_shard"] for r in out)


def test_shards_over_several_buckets(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 50).alias("text"))
    out = rows(shards.assign(df, 4, bucket_bytes=8000))
    for s in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    shards.write(df, str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3000


def test_slots_do_not_follow_the_layout(spark, sf):
    """Any number of partitions, AQE on or off: the same slots; another seed: others."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    own = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    seen = []
    for partitions, adaptive, files, lanes in ((2, "true", 1, 8000), (3, "false", 5, 8000), (8, "true", 3, 8000), (3, "false", 2, 8000)):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        seen.append(sorted((r.doc_id, r.shard, r.slot) for r in shards.assign(docs.repartition(files), 4, bucket_bytes=lanes).collect()))
    for k, v in own.items():
        spark.conf.set(k, v)
    assert all(s == seen[0] for s in seen)
    other = sorted((r.doc_id, r.shard, r.slot) for r in shards.assign(docs, 4, seed=1, bucket_bytes=8000).collect())
    assert other != seen[0]


def test_shards_by_hand(docs):
    """The shard with the highest hash, in plain Python."""
    want = {}
    for r in docs.select("doc_id").distinct().collect():
        own = [] if r.doc_id is None else [(r.doc_id, 8)]
        each = [spark_hash((shards.SEED, 4), *own, (s, 4)) for s in range(41)]
        best = max(range(40), key=lambda s: (each[s], s))
        want[r.doc_id] = (best, 40 if each[40] > each[best] else best)
    out = rows(shards.digest(docs))
    assert out and all((r["shard"], r["grown_shard"]) == want[r["doc_id"]] for r in out)


def plain_targets(sizes, weights, most=3):
    """Shares of all sizes by weight; what is above `most` times its size stops there, the rest is shared anew."""
    out, full = [0.0] * len(sizes), set()
    while len(full) < len(sizes):
        left, open_ = sum(sizes) - sum(most * sizes[i] for i in full), [i for i in range(len(sizes)) if i not in full]
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > most * sizes[i]]
        if not over:
            return [share.get(i, float(most * sizes[i])) for i in range(len(sizes))]
        full |= set(over)
    return [float(most * x) for x in sizes]


def plain_goals(docs):
    """source -> (words, target)."""
    sums = {}
    for r in rows(docs.select("source", "text")):
        sums[r["source"]] = sums.get(r["source"], 0) + len(GAPS.findall(r["text"] or ""))
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    return dict(zip(order, zip([sums[s] for s in order], plain_targets([sums[s] for s in order], [i % 3 + 1 for i in range(len(order))]), strict=True), strict=True))


@pytest.mark.parametrize("block", [mixing.BLOCK_WORDS, 32])
def test_mixing(docs, block):
    out = rows(mixing.digest(docs, block))
    texts = Counter((r.doc_id, len(GAPS.findall(r.text or ""))) for r in docs.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["size"]) for r in out) == texts
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    goals = plain_goals(docs)
    assert sorted({(r["source_size"], round(r["target"], 6)) for r in out}) == sorted({(n, round(t, 6)) for n, t in goals.values()})
    own = {(n, round(t, 6)): t for n, t in goals.values()}
    taken = Counter()
    for r in out:
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    if len(own) == len(goals):  # each source's words are its target, cut to a whole number
        assert all(0 <= t - taken[k] < 1 + 1e-3 for k, t in own.items())
    assert sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in rows(mixing.digest(docs.repartition(7), block))) == sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in out)


def test_mixing_targets_stop_at_three_times(spark, monkeypatch):
    rng = np.random.default_rng(4)
    for few in (mixing.SMALL_TABLE, 0):
        monkeypatch.setattr(mixing, "SMALL_TABLE", few)
        for sizes in ([10, 1000, 1000], [5], [0, 0], [int(x) for x in np.exp(rng.normal(5, 3, 40))]):
            df = spark.createDataFrame([(f"s{i:03d}", n) for i, n in enumerate(sizes)], "source string, size long")
            got = [r.target for r in mixing.plan(df).orderBy("k").collect()]
            assert np.allclose(got, plain_targets(sizes, [i % 3 + 1 for i in range(len(sizes))]), atol=1e-6)


def test_slots_permute_blocks_and_fill_shards(spark):
    df = spark.createDataFrame([("a", 300_000), ("b", 40_500), ("c", 900)], "source string, size long")
    plan = mixing.plan(df, block=100)
    sources = {r.k: r for r in plan.collect()}
    dealt = rows(mixing.slots(plan, 10))
    for k, r in sources.items():
        mine = [x for x in dealt if x["k"] == k]
        assert len(mine) == r.slots and sum(x["words"] is not None for x in mine) == (r.last > 0)
        for turn in range(r.passes):
            assert sorted(x["block"] for x in mine if x["turn"] == turn) == list(range(r.blocks))  # each whole pass takes every block
        last = [x["block"] for x in mine if x["turn"] == r.passes]
        assert len(set(last)) == len(last) == r.open and all(0 <= x < r.blocks for x in last)
        counts = Counter(x["shard"] for x in mine)
        if r.slots > 1000:  # multinomial: near equal shares, not equal ones
            assert all(abs(n - r.slots / 10) < 5 * (r.slots / 10) ** 0.5 for n in counts.values()) and len(set(counts.values())) > 1
    big = [x["block"] for x in sorted((x for x in dealt if x["k"] == 0), key=lambda x: (x["turn"], x["shard"]))]
    assert sum(a + 1 == b for a, b in zip(big, big[1:], strict=False)) < 0.2 * len(big)  # not in order


def spark_hash(*values):
    """xxhash64 of Spark over whole numbers: (value, bytes) each, chained by the seed."""
    h = 42
    for v, wide in values:
        h = xxhash.xxh64_intdigest(v.to_bytes(wide, "little", signed=True), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_counts_are_the_shards_draws(spark):
    """Every slot's draw, counted in plain Python; the settled counts lose from the last shards and gain in all."""
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate([5000, 70_000, 0, 900, 33_000, 120])], "source string, size long")
    plan, shards = mixing.plan(df, block=100), 7
    own = sorted(plan.collect(), key=lambda r: r.k)
    total = sum(r.slots for r in own)
    ends = np.cumsum([r.slots for r in own])
    want = Counter()
    for s in range(shards):
        for slot in range(s * total // shards, (s + 1) * total // shards):
            u = spark_hash((77, 4), (s, 4), (slot, 8)) % total
            want[s, own[int(np.searchsorted(ends, u, "right"))].k] += 1
    draws = mixing.drawn(plan, shards, 77)
    assert {(r.shard, r.k): r.n for r in draws.collect()} == want
    out = {(r.shard, r.k): r.n for r in mixing.settled(plan, draws, shards).collect()}
    for r in own:
        many, n = r.slots, [want[s, r.k] for s in range(shards)]
        for s in reversed(range(shards)):
            over = max(0, sum(n) - many)
            n[s] -= min(over, n[s])
        lack = many - sum(n)
        n = [x + (s + 1) * lack // shards - s * lack // shards for s, x in enumerate(n)]
        assert [out.get((s, r.k), 0) for s in range(shards)] == n and sum(n) == many


def test_feistel_walks_permute(spark):
    sizes = [1, 2, 3, 5, 7, 16, 17, 99, 500, 1601]
    df = spark.createDataFrame([(n, i) for n in sizes for i in range(n)], "n long, i long").select("n", mixing.permuted(F.col("i"), F.col("n"), F.lit(5), F.col("n")).alias("to"))
    got = {}
    for r in df.collect():
        got.setdefault(r.n, []).append(r.to)
    assert all(sorted(got[n]) == list(range(n)) for n in sizes) and got[500] != sorted(got[500])


def test_the_draw_decides_what_is_taken(spark, sf):
    """Other draws, or another number of shards, take other blocks once more; each source's words stay."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    taken = [{r["doc_id"]: (r["source_size"], r["taken"]) for r in rows(mixing.digest(docs, 32, **how))} for how in ({}, {"draw": 1}, {"draw": 2}, {"shards": 7})]
    for a, b in itertools.combinations(taken, 2):
        assert a != b
        sums = [Counter() for _ in range(2)]
        for own, of in zip(sums, (a, b), strict=True):
            for size, n in of.values():
                own[size] += n
        assert sums[0] == sums[1]


def test_taken_words_by_hand(spark, sf):
    """From the slots and the order of the documents: every word of a block that a slot takes is one use."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    own, _, dealt = mixing.mix(mixing.sizes(docs.select("doc_id", "source", "text")), block=32)
    streams, placed = {}, rows(own)
    for r in placed:
        for w in range(r["size"]):
            streams.setdefault(r["k"], {})[r["at"] + w] = r["row"]
    want = Counter()
    for x in rows(dealt):
        stream = streams[x["k"]]
        for at in range(x["block"] * 32, x["block"] * 32 + (x["words"] or 32)):
            if at in stream:
                want[stream[at]] += 1
    got = Counter((r["doc_id"], r["taken"]) for r in rows(mixing.digest(docs, 32)))
    assert got == Counter((r["doc_id"], want[r["row"]]) for r in placed)
    assert all(sorted(s) == list(range(len(s))) for s in streams.values())


def test_mixed_texts_hold_the_taken_words(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for block in (mixing.BLOCK_WORDS, 40):
        taken = {r["doc_id"]: r["taken"] for r in rows(mixing.digest(docs, block))}
        out = mixing.taken_texts(docs, block)
        assert out.columns == docs.columns
        got = Counter()
        for r in rows(out):
            got[r["doc_id"]] += len(GAPS.findall(r["text"]))
            assert r["n_chars"] == len(r["text"])
            assert all(part.strip() in texts[r["doc_id"]] for part in (r["text"].split("\n") if r["text"] != texts[r["doc_id"]] else [r["text"]]))  # line breaks and blanks as they were
        assert all(got[i] == n for i, n in taken.items())


def test_mixing_keeps_clashing_columns(spark):
    names = ["doc_id", "text", "source", "n_chars", "size", "runs", "at", "pass", "k", "row", "document", "key", "pieces", "block"]
    data = [(i, f"w{i} " * 50, "s" if i % 2 else "t", 7, "a", "b", "c", "d", "e", "f", "g", "h", "i", "j") for i in range(6)]
    out = mixing.taken_texts(spark.createDataFrame(data, names))
    assert out.columns == names
    assert {tuple(r)[4:] for r in out.collect()} == {data[0][4:]}


def test_language(docs):
    out = rows(langid.identify(docs))
    texts = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert len(out) == docs.count()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in out)
    blank = {i for i, t in texts if not langid.has_letter(t)}
    assert all(r["lang_pred"] == "und" for r in out if r["doc_id"] in blank)


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    both = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in both]) >= 0.97


def test_toxicity(docs, labels, spark, sf):
    marks = labels if "shard" in docs.columns else spark.read.parquet(f"{sf}/labels.parquet")
    out = rows(toxicity.score(docs, marks))
    assert len(out) == docs.count()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_toxic_documents_are_found(spark):
    """Held out at sf0.1: most toxic documents are found, and few clean ones are taken for toxic."""
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    held = toxicity.score(docs, marks).join(marks.filter("toxic IS NOT NULL"), "doc_id").filter("held_out").collect()
    toxic, clean = [r.predicted for r in held if r.toxic == 1], [r.predicted for r in held if r.toxic == 0]
    assert len(toxic) > 50 and np.mean(toxic) >= 0.8 and np.mean(clean) <= 0.03


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda bags, ys, rate: seen.append((bags, ys)) or fit(bags, ys, rate))
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 100_000)
    toxicity.train_fold(docs, marks)
    (bags, ys), = seen
    for y in (0, 1):
        assert 20_000 < sum(4 * (len(a) + len(n)) for (a, n), label in zip(bags, ys, strict=True) if label == y) <= 100_000


def test_toxicity_learns_sentences(spark):
    sf = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = toxicity.score(docs, marks).join(marks, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in held]) >= 0.95
    model = toxicity.train_fold(docs, marks)
    found = rows(toxicity.locate(docs, model))
    assert found and all(0 <= r["start"] < r["end"] for r in found)


@pytest.mark.parametrize("name", ["bpe", "toxicity", "quality", "language", "license", "shards", "mixing"])
def test_empty_tables(name, nothing, labels):
    run = {
        "bpe": lambda: bpe.digest(nothing, registry.tokenizer_path()),
        "toxicity": lambda: toxicity.score(nothing, labels),
        "quality": lambda: quality.judge(nothing, labels),
        "language": lambda: langid.identify(nothing),
        "license": lambda: license_scan.digest(nothing),
        "shards": lambda: shards.digest(nothing),
        "mixing": lambda: mixing.digest(nothing),
    }[name]
    assert run().collect() == []
