"""Mixing sources to target weights by drawing fixed-length blocks.

The words of a source, documents in seeded order, are one stream that is cut
into blocks of equal length. Targets share all words over the sources by
weight and stop at `most` times a source's own size; a source's target is a
number of slots of the mix. Every output shard has equally many slots, and
draws the source of each by the sources' shares: its counts are one
multinomial draw. So that each source's words are its target, cut to a whole
number, the draws are settled: what a source has too much goes from its last
shards, what it lacks is dealt to all shards in equal parts.

A source's slots are mapped through permutations of its whole blocks, one for
each pass over them (a Feistel network with cycle walking). Of every pass that
is whole each block has a slot. Of the last, open pass each shard takes the
slots it has drawn from its own stretch of the permutation (behind the shard
before it, where that took more than its stretch), so the draw decides which
blocks are taken once more. The source's last, shorter block stands at the end
of a whole pass. Blocks and documents are joined by block index.

DataFrame functions only; sources are a table like any other, however many
there are. Defined results: null and empty texts have size 0 and are never
taken; texts of any length are taken whole or in blocks; null sources are one
source, last in order; repeated rows are records of their own; ties in the
seeded order go by id and then by record; an empty table gives no rows;
taken_texts() returns the columns of its input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.text import WORD
from lotwise.session import cut

SEED = 20_240_610
BLOCK_WORDS = 1024
SHARDS = 40
MOST = 3
CHUNK_ROWS = 4096  # documents of a source that are put in order together
RUN_SLOTS = 1 << 16  # slots of a source that are made together
SMALL_TABLE = 100_000  # sources; a table of as many is broadcast, a larger one is joined
GROUP = 4096  # sources whose shares are summed up together
ROUNDS = 4
WALK = 40  # steps of a walk: more than enough below 1,600 blocks, and beyond that a step fails once in the root of the blocks


def weight(k: Column) -> Column:
    """The weight of source number k: 1, 2, 3, repeating."""
    return k % 3 + 1


def numbered(sources: DataFrame) -> DataFrame:
    """sources with k: their place by code point, null last. Numbered within ranges, so no task holds all of them."""
    key = (F.col("source").isNull(), F.col("source"))
    placed = cut(sources.withColumn("part", F.lit(0)) if sources.count() <= SMALL_TABLE else sources.repartitionByRange(*key).withColumn("part", F.spark_partition_id()))
    before = placed.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(W.orderBy("part")) - F.col("n")).select("part", "before")  # a row a range
    at = F.row_number().over(W.partitionBy("part").orderBy(*key)) - 1
    return placed.withColumn("at", at).join(F.broadcast(before), "part").withColumn("k", F.col("before") + F.col("at")).drop("part", "at", "before")


def targets(sources: DataFrame, most: float = MOST, weights=weight) -> DataFrame:
    """sources (k, size) with target: shares of all sizes by weight; one above most * size stops there, and the rest is shared anew."""
    out = cut(sources.withColumns({"weight": weights(F.col("k")).cast("double"), "full": F.lit(False)}))
    while True:
        # what is left for the open sources, and their weight
        left = out.agg(F.sum("size").alias("all"), F.sum(F.when(F.col("full"), most * F.col("size"))).alias("used"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("open")).first()
        if not left.open:
            return out.withColumn("target", F.col("size") * F.lit(float(most)))
        share = F.lit(float((left.all or 0) - (left.used or 0))) * F.col("weight") / F.lit(left.open)
        out = out.withColumn("share", share)
        over = ~F.col("full") & (F.col("share") > most * F.col("size"))
        if out.filter(over).isEmpty():
            return out.withColumn("target", F.when(F.col("full"), F.col("size") * F.lit(float(most))).otherwise(F.col("share"))).drop("share")
        out = cut(out.withColumn("full", F.col("full") | over).drop("share"))


def permuted(at: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of the numbers below n: Feistel rounds on a rectangle of at least n, walked until below n."""
    wide = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    high = F.floor((n + wide - 1) / wide).cast("long")

    def turned(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(*key, 2 * i, s["r"]), wide), wide)
        return F.transform(F.array(left), lambda x: F.struct(x.alias("l"), F.pmod(s["r"] + F.pmod(F.xxhash64(*key, 2 * i + 1, x), high), high).alias("r")))[0]

    def once(x: Column) -> Column:
        first = F.struct(F.floor(x / high).cast("long").alias("l"), (x % high).alias("r"))
        return F.reduce(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turned, lambda s: s["l"] * high + s["r"])

    return F.reduce(F.sequence(F.lit(1), F.lit(WALK)), once(at), lambda x, _: F.when(x < n, x).otherwise(once(x)))


def plan(sized: DataFrame, weights=weight, block: int = BLOCK_WORDS, most: float = MOST) -> DataFrame:
    """A row a source: number k, size, target, whole blocks, words of the last block, slots, those of the open pass, words of its last slot.

    sized: source, size of the documents.
    """
    sources = targets(numbered(sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))), most, weights)
    goal = F.floor(F.col("target") + 1e-6).cast("long")
    d = sources.withColumns({"whole": F.floor(F.col("size") / block), "tail": F.col("size") % block, "goal": goal})
    d = d.withColumns({"passes": F.when(F.col("size") > 0, F.floor(F.col("goal") / F.col("size"))).otherwise(0), "blocks": F.col("whole") + (F.col("tail") > 0).cast("long")})
    rest = F.col("goal") - F.col("passes") * F.col("size")  # words of the open pass
    d = d.withColumns({"open": F.ceil(rest / block), "last": rest % block})
    d = d.withColumn("slots", F.col("passes") * F.col("blocks") + F.col("open"))
    return cut(d.select("k", "source", F.col("size").alias("source_size"), "target", "docs", "whole", "tail", "blocks", "passes", "slots", "open", "last"))


def ranges(sources: DataFrame) -> DataFrame:
    """k, lo, hi: each source's part of all slots, one behind the other; summed up in groups, so no task holds all sources."""
    d = sources.filter("slots > 0").select("k", "slots", F.floor(F.col("k") / GROUP).alias("group"))
    groups = d.groupBy("group").agg(F.sum("slots").alias("n"))
    before = groups.select("group", (F.sum("n").over(W.orderBy("group")) - F.col("n")).alias("before"))  # a row for GROUP sources
    own = F.sum("slots").over(W.partitionBy("group").orderBy("k"))
    return d.withColumn("own", own).join(before, "group").select("k", (F.col("before") + F.col("own") - F.col("slots")).alias("lo"), (F.col("before") + F.col("own")).alias("hi"))


def drawn(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """shard, k, n: how many of the shard's slots fall to the source when each draws its source by the sources' shares."""
    sums = sources.agg(F.sum("slots").alias("slots"), F.count("*").alias("sources")).first()
    total = sums.slots or 0
    bins = max(1024, 4 * sums.sources)  # parts of [0, total), by which drawn numbers find their source
    bin_of = lambda c: F.floor(c.cast("decimal(20,0)") * bins / max(1, total)).cast("long")
    found = ranges(sources)
    found = small(found.withColumn("bin", F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi") - 1)))), bins + sums.sources)
    sizes = sources.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"), *[F.floor((F.col("id") + x).cast("decimal(20,0)") * total / shards).cast("long").alias(c) for c, x in (("a", 0), ("b", 1))])
    runs = sizes.filter("b > a").withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("b") - F.col("a") - 1) / RUN_SLOTS)))).repartition("shard", "run")
    each = runs.select("shard", F.explode(F.sequence(F.col("a") + F.col("run") * RUN_SLOTS, F.least(F.col("a") + (F.col("run") + 1) * RUN_SLOTS, F.col("b")) - 1)).alias("slot"))
    each = each.select("shard", F.pmod(F.xxhash64(F.lit(seed), "shard", "slot"), F.lit(max(1, total))).alias("u")).withColumn("bin", bin_of(F.col("u")))
    return each.join(found, "bin").filter("u >= lo AND u < hi").groupBy("shard", "k").agg(F.count("*").alias("n"))


def settled(sources: DataFrame, draws: DataFrame, shards: int) -> DataFrame:
    """sources with shard, n and before: the draws, brought to each source's slots. A row for every shard and source."""
    every = sources.filter("slots > 0").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    d = every.join(draws, ["shard", "k"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    upto = W.partitionBy("k").orderBy("shard")
    d = d.withColumns({"sum": F.sum("n").over(upto), "all": F.sum("n").over(W.partitionBy("k"))})
    lack = F.greatest(F.col("slots") - F.col("all"), F.lit(0))
    part = lambda x: F.floor((F.col("shard") + x) * lack / shards).cast("long")
    n = F.least("sum", "slots") - F.least(F.col("sum") - F.col("n"), F.col("slots")) + part(1) - part(0)
    d = d.withColumn("n", n).withColumn("before", F.sum("n").over(upto) - F.col("n"))
    return d.drop("sum", "all")


def slots(sources: DataFrame, shards: int = SHARDS, seed: int = SEED, draw: int | None = None) -> DataFrame:
    """k, shard, turn, block and words (null: all of the block) of every slot of the mix. draw: seed of the shards' draws."""
    d = settled(sources, drawn(sources, shards, seed + 3 if draw is None else draw), shards)
    # the part of a shard's slots that is of the open pass: in proportion, cut to whole numbers
    opened = lambda c: F.floor(c.cast("decimal(20,0)") * F.col("open") / F.col("slots")).cast("long")
    d = d.withColumns({"done": opened(F.col("before")), "o": opened(F.col("before") + F.col("n")) - opened(F.col("before"))})
    # a shard's stretch of the open pass begins at its share of the blocks, or behind the shard before it; all fit in
    room = F.when(F.col("open") > F.col("whole"), F.col("blocks")).otherwise(F.col("whole"))
    share = F.floor(F.col("shard") * room / shards).cast("long")
    behind = F.max(share - F.col("done")).over(W.partitionBy("k").orderBy("shard"))
    d = d.withColumn("start", F.col("done") + F.least(behind, room - F.col("open")))
    parts = F.array(
        F.struct(F.lit(False).alias("opened"), (F.col("before") - F.col("done")).alias("first"), (F.col("n") - F.col("o")).alias("many")),
        F.struct(F.lit(True).alias("opened"), F.col("start").alias("first"), F.col("o").alias("many")),
    )
    d = d.select("*", F.inline(parts)).filter("many > 0")
    runs = d.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("many") - 1) / RUN_SLOTS))))
    runs = runs.repartition("k", "shard", "run", "opened")  # no task makes all slots of a large source
    each = runs.withColumn("place", F.explode(F.sequence(F.col("first") + F.col("run") * RUN_SLOTS, F.col("first") + F.least((F.col("run") + 1) * RUN_SLOTS, F.col("many")) - 1)))
    at = F.when(F.col("opened"), F.col("place")).otherwise(F.col("place") % F.col("blocks"))
    turn = F.when(F.col("opened"), F.col("passes")).otherwise(F.floor(F.col("place") / F.col("blocks")))
    final = F.col("opened") & (F.col("done") + F.col("o") == F.col("open")) & (F.col("place") == F.col("start") + F.col("o") - 1)
    each = each.select("k", "shard", turn.alias("turn"), at.alias("at"), "whole", F.when(final & (F.col("last") > 0), F.col("last")).alias("words"))
    inner = permuted(F.col("at"), F.greatest(F.col("whole"), F.lit(1).cast("long")), F.lit(seed + 2), F.col("k"), F.col("turn"))
    return each.select("k", "shard", "turn", F.when(F.col("at") < F.col("whole"), inner).otherwise(F.col("whole")).alias("block"), "words")


def small(table: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast if it has few rows; rows: a bound of them, if one is known."""
    return F.broadcast(table) if (table.count() if rows is None else rows) <= SMALL_TABLE else table


def placed(docs: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """docs (doc_id, source, size, digest, row) with k and `at`: the place of the document's first word in its source's stream."""
    few = small(sources.select("k", F.col("source").alias("of"), "source_size", "target", "docs"))
    docs = docs.join(few, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    docs = docs.withColumn("mix", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("digest")))
    docs = docs.withColumn("chunk", F.pmod(F.col("mix"), F.ceil(F.col("docs") / CHUNK_ROWS)))
    sums = docs.groupBy("k", "chunk").agg(F.sum("size").alias("n"))
    before = sums.withColumn("before", F.sum("n").over(W.partitionBy("k").orderBy("chunk")) - F.col("n")).drop("n")
    order = W.partitionBy("k", "chunk").orderBy("mix", "doc_id", "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    docs = docs.withColumn("own", F.sum("size").over(order) - F.col("size")).join(before, ["k", "chunk"])
    return docs.withColumn("at", F.col("before") + F.col("own")).drop("before", "own", "chunk", "mix", "docs")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, digest of the text, and a number for each record."""
    sized = docs.select("doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.xxhash64("text").alias("digest"))
    return cut(sized.withColumn("row", F.monotonically_increasing_id()))


def mix(sized: DataFrame, weights=weight, block: int = BLOCK_WORDS, shards: int = SHARDS, most: float = MOST, seed: int = SEED, draw: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes() with source_size, target, k, at; k, block, uses and words of one further use; slots)."""
    sources = plan(sized, weights, block, most)
    dealt = slots(sources, shards, seed, draw)
    uses = dealt.groupBy("k", "block").agg(F.count_if(F.col("words").isNull()).alias("uses"), F.coalesce(F.max("words"), F.lit(0)).alias("part"))
    return placed(sized, sources, seed), uses, dealt


def overlaps(docs: DataFrame, uses: DataFrame, block: int) -> DataFrame:
    """row, and for each block that holds words of the document: first and end of these in the document, uses, and the end of a further use."""
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)
    each = docs.filter(F.col("size") > 0).select("row", "k", "at", "size", F.explode(F.sequence(first, last)).alias("block")).join(uses, ["k", "block"])
    lo = F.greatest(F.col("block") * block - F.col("at"), F.lit(0))
    hi = F.least((F.col("block") + 1) * block - F.col("at"), F.col("size"))
    return each.select("row", lo.alias("lo"), hi.alias("hi"), "uses", F.greatest(lo, F.least(hi, F.col("block") * block + F.col("part") - F.col("at"))).alias("stop"))


def digest(docs: DataFrame, block: int = BLOCK_WORDS, shards: int = SHARDS, draw: int | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    own, uses, _ = mix(sizes(docs.select("doc_id", "source", "text")), block=block, shards=shards, draw=draw)
    words = (F.col("hi") - F.col("lo")) * F.col("uses") + F.col("stop") - F.col("lo")
    taken = overlaps(own, uses, block).groupBy("row").agg(F.sum(words).alias("taken"))
    out = own.join(taken, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def taken_texts(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: for every pass over the blocks, a row with the words that the pass takes.

    Columns are those of docs (with doc_id, source, text); a text that a pass takes whole stays as it is, of others the
    taken stretches are cut out with all that stands between their words, and joined by a line break where some words are
    left out. n_chars, if there, follows the text.
    """
    sized = sizes(docs.select("doc_id", "source", "text"))
    own, uses, _ = mix(sized, block=block)
    parts = overlaps(own, uses, block)
    # the words that each pass takes: a use of a block each, and the beginning of one block
    passes = parts.select("row", "lo", "hi", F.explode(F.sequence(F.lit(1).cast("long"), F.col("uses") + (F.col("stop") > F.col("lo")).cast("long"))).alias("turn"), "uses", "stop")
    passes = passes.filter("uses > 0 OR stop > lo").select("row", "turn", "lo", F.when(F.col("turn") > F.col("uses"), F.col("stop")).otherwise(F.col("hi")).alias("hi")).filter("hi > lo")
    runs = passes.groupBy("row", "turn").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("runs"))
    runs = runs.groupBy("row").agg(F.collect_list("runs").alias("passes"))  # a few passes, a run for each block of the text
    taken = own.join(runs, "row").select(F.struct("doc_id", "source", "digest").alias("key"), "size", "passes")
    # rows that are equal in all of the key share one text
    text = docs.select(F.struct("doc_id", "source", F.xxhash64("text").alias("digest")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")).dropDuplicates(["key"])
    both = text.join(taken, "key").select("document", "size", F.explode("passes").alias("runs"))
    # stretches as (start, length) in words: neighbouring runs are one
    joined = F.aggregate("runs", F.array().cast("array<struct<lo:bigint,hi:bigint>>"), lambda acc, r: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] == r["lo"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["lo"].alias("lo"), r["hi"].alias("hi"))))).otherwise(F.concat(acc, F.array(r))))
    both = both.withColumn("runs", joined)
    body = F.col("document.text")
    whole = (F.size("runs") == 1) & (F.get("runs", F.lit(0))["lo"] == 0) & (F.get("runs", F.lit(0))["hi"] == F.col("size"))
    # words with what follows them up to the next word; the pieces before the first word have no word
    pieces = F.when(whole, F.array().cast("array<string>")).otherwise(F.regexp_extract_all(body, F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1)))
    both = both.withColumn("pieces", pieces)
    part = F.array_join(F.transform("runs", lambda r: F.rtrim(F.array_join(F.slice("pieces", (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")), ""))), "\n")
    new = F.when(whole, body).otherwise(part)
    fields = {"text": new}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.char_length(new).cast(docs.schema["n_chars"].dataType)
    return both.select(*[fields.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns])
