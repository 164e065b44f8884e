"""Quality rules whose cutoffs carry a risk guarantee.

Each rule rejects a document whose share of something (symbols, repeated
words, repeated lines, capitals) lies above a cutoff. A setting has a cutoff
for every rule. For each stratum (language), a sequence of settings, from
lenient to strict, is laid down on the bad documents and on a fold of the good
ones: each rule's strictest cutoff that loses at most a given share of that
fold, first with some steps of slack, and only if it rejects a larger share of
the bad ones. The other good documents, which had no part in this, test the
settings in that order: a setting is certified when an exact binomial test
rejects "more than `risk` of the good documents are lost by any rule", and
testing stops at the first one that fails, so a sequence needs one level only.
Levels are divided (Bonferroni) over the strata with enough good documents for
any test to succeed. Of the certified settings the one with the best balance
of bad documents rejected and good ones lost is taken; where nothing can be
certified the rules are off and documents are kept, which the output says.

All of it is DataFrame and SQL functions; settings are a table that documents
are joined with. Defined results: null and empty texts have zero counts and
fail the base rule (fewer than 50 words); texts of any length count whole;
null languages are a stratum of their own; several labels of one id count as
good only if all do; without labels every document that passes the base is
kept; shares equal to a cutoff pass, and of equally good settings the most
lenient is taken; repeated rows get equal results; an empty table gives no
rows; keep() returns all columns as they were, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.text import GAP, fold
from lotwise.session import cut

RISK = 0.02  # share of good documents that all rules together may lose in a stratum
LEVEL = 0.05  # chance that any of the guarantees is wrong
GRID = (60, 50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1)  # cutoffs in percent
RULES = ("symbols", "repeats", "lines", "capitals")
TUNING = 4  # one of so many good documents helps to lay down the settings, the others test them
STEPS = ((0.0, 6), (0.0, 4), (0.0, 3), (0.0, 2), (0.0, 1), (0.0, 0), (0.005, 0), (0.01, 0), (0.02, 0), (0.03, 0))  # share of the fold lost, steps of slack
SMALL_TABLE = 100_000  # strata; the settings of as many are broadcast, of more they are joined
BLANKS = " \t\n\x0b\x0c\r"


def measured(docs: DataFrame) -> DataFrame:
    """docs with the column `q`: a struct of the base counts and of what the rules need."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(BLANKS))
    d = docs.withColumn("__w", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP)))
    d = d.withColumn("__n", F.size("__w")).withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    # hashes of the 3-word windows, by start
    d = d.withColumn("__t", F.expr("CASE WHEN __n < 3 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, __n - 3), i -> xxhash64(__h[i], __h[i + 1], __h[i + 2])) END"))
    # sorted by hash with the start in the low bits, so that equal windows are neighbours
    d = d.withColumn("__b", F.expr("CAST(ceil(log2(__n + 2)) AS int)"))
    d = d.withColumn("__s", F.expr("CASE WHEN size(array_distinct(__t)) = size(__t) THEN CAST(array() AS array<bigint>) ELSE sort_array(transform(__t, (x, i) -> shiftleft(shiftright(x, __b), __b) | CAST(i AS bigint))) END"))
    start = "CAST({} & (shiftleft(1L, __b) - 1) AS int)"
    same = f"__t[{start.format('x')}] = __t[{start.format('__s[{}]')}]"
    d = d.withColumn("__d", F.expr(f"array_sort(transform(filter(__s, (x, i) -> (i > 0 AND {same.format('greatest(i - 1, 0)')}) OR (i < size(__s) - 1 AND {same.format('least(i + 1, size(__s) - 1)')})), x -> {start.format('x')}))"))
    d = d.withColumn("__r", F.expr("aggregate(transform(__d, (x, i) -> CASE WHEN i = size(__d) - 1 THEN 3L ELSE CAST(least(3, __d[least(i + 1, size(__d) - 1)] - x) AS bigint) END), 0L, (a, x) -> a + x)"))
    d = d.withColumn("__l", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    n = F.col("__n").cast("long")
    q = F.struct(
        n.alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.col("__r").alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    return d.withColumn("q", q).drop(*[f"__{c}" for c in "wnhtbsdrl"])


def percent(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(100.0 * F.col(f"q.{part}"), F.col(f"q.{whole}")), F.lit(0.0))


def shares() -> dict[str, Column]:
    return {
        "symbols": percent("n_symbols", "word_chars"),
        "repeats": percent("n_repeat_words", "n_words"),
        "lines": percent("n_dup_lines", "n_lines"),
        "capitals": percent("n_capitals", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("q.n_words") < 50) | (100 * F.col("q.n_repeat_words") > 50 * F.col("q.n_words"))


def stratum() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("null"))


def certified(cells: DataFrame, risk: float, level: Column) -> DataFrame:
    """cells: n good documents, k lost. Adds `holds`: P(X <= k) <= level for X ~ Bin(n, risk), summed exactly."""
    tail = F.expr(
        f"aggregate(sequence(0L, k), named_struct('t', n * ln({1 - risk}D), 's', 0D), "
        f"(a, i) -> named_struct('t', a.t + ln(greatest(n - i, 0.5D) / (i + 1)) + ln({risk / (1 - risk)}D), 's', a.s + exp(a.t)), a -> a.s)"
    )
    return cells.withColumn("holds", F.when((F.col("n") > 0) & (F.col("k") <= F.col("n") * risk), tail <= level).otherwise(False))


def settings(rows: DataFrame) -> DataFrame:
    """stratum, step and a cutoff for each rule (null: off), from the bad rows and the tuning fold. rows: what labelled() returns."""
    at = "CASE " + " ".join(f"WHEN share > {c} THEN {i}" for i, c in enumerate(GRID)) + f" ELSE {len(GRID)} END"
    used = rows.filter(~F.col("good") | F.col("tuning"))
    stack = used.select("stratum", "good", F.expr(f"stack({len(RULES)}, {', '.join(f'{r!r}, {r}' for r in RULES)}) AS (rule, share)"))
    counts = stack.groupBy("stratum", "rule", F.expr(at).alias("at")).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    # each rule's good and bad rows by the first cutoff that they lie above: at most a row for each cutoff
    rules = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n"), F.sum("bad").alias("n_bad"), F.collect_list(F.struct("at", "good", "bad")).alias("cells"))
    above = lambda c, of: f"aggregate(filter(cells, c -> c.at <= {c}), 0L, (s, c) -> s + c.{of})"
    grid = f"sequence(0, {len(GRID) - 1})"
    steps = ", ".join(f"array_max(filter({grid}, i -> {above('i', 'good')} <= {share}D * n)) - {slack}" for share, slack in STEPS)
    chosen = rules.select("stratum", "rule", "n", "n_bad", "cells", F.posexplode(F.expr(f"array({steps})")).alias("step", "i"))
    gains = f"i >= 0 AND {above('i', 'bad')} * greatest(n, 1L) > {above('i', 'good')} * n_bad"
    chosen = chosen.withColumn("cut", F.expr(f"CASE WHEN {gains} THEN CAST(array({', '.join(map(str, GRID))})[greatest(i, 0)] AS double) END"))
    return chosen.groupBy("stratum", "step").agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])


def choose(rows: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """stratum, a cutoff for each rule (null: off), good (documents that tested it) and lost, of the strata with a certified setting."""
    tests = rows.filter(~F.col("good") | ~F.col("tuning")).join(settings(rows), "stratum")
    out = F.lit(False)
    for r in RULES:
        out = out | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    cuts = [f"cut_{r}" for r in RULES]
    cells = tests.groupBy("stratum", "step", *cuts).agg(F.count_if("good").alias("n"), F.count_if(F.col("good") & out).alias("k"), F.count_if(~F.col("good")).alias("n_bad"), F.count_if(~F.col("good") & out).alias("hit"))
    cells = cut(cells)
    able = cells.filter(F.col("n") >= math.log(level) / math.log(1 - risk)).select("stratum").distinct().count()
    cells = certified(cells, risk, F.lit(level / max(1, able)))
    cells = cells.withColumn("open", F.min(F.col("holds").cast("int")).over(W.partitionBy("stratum").orderBy("step")) == 1)  # nothing more lenient has failed
    gain = F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("n_bad")), F.lit(0.0)) - F.coalesce(F.try_divide(F.col("k").cast("double"), F.col("n")), F.lit(0.0))
    best = cells.filter(F.col("open") & (F.col("hit") > 0)).groupBy("stratum").agg(F.min_by(F.struct(*cuts, F.col("n").alias("good"), F.col("k").alias("lost")), F.struct(-gain, F.col("step"))).alias("b"))
    return cut(best.select("stratum", "b.*"))


def with_settings(measures: DataFrame, chosen: DataFrame) -> DataFrame:
    """measures with the settings of their stratum and `kept`."""
    few = F.broadcast(chosen) if chosen.count() <= SMALL_TABLE else chosen
    rows = measures.withColumn("stratum", stratum()).join(few, "stratum", "left")
    keep = ~base_failed()
    for rule, share in shares().items():
        keep = keep & F.coalesce(share <= F.col(f"cut_{rule}"), F.lit(True))
    return rows.withColumn("kept", keep)


def labelled(measures: DataFrame, labels: DataFrame) -> DataFrame:
    """stratum, good, tuning and a share for each rule, of the labelled documents that pass the base."""
    one = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    rows = measures.filter(~base_failed()).select("doc_id", stratum().alias("stratum"), *[s.alias(r) for r, s in shares().items()])
    return rows.join(one, "doc_id").select("stratum", "good", (fold(F.col("doc_id"), TUNING) == 0).alias("tuning"), *RULES)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and what the stratum's guarantee rests on: good documents tested and lost (null: rules off)."""
    m = cut(measured(docs.select("doc_id", "lang", "text")).select("doc_id", "lang", "q"))
    out = with_settings(m, choose(labelled(m, labels)))
    return out.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", base_failed().alias("base_failed"), "kept", F.col("good").alias("tested"), "lost")


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    whole = docs.select("doc_id", "lang", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    m = cut(measured(whole).select("doc_id", "lang", "q", "document"))  # each text is measured once
    return with_settings(m, choose(labelled(m, labels))).filter("kept").select("document.*")
