"""Sharding by a two-pass external shuffle.

Pass one scatters the records over buckets that fit in memory, by seeded
hashes: the shard is the one with the highest hash of (doc_id, shard), so that
another shard takes rows only into itself, and a further hash spreads a
shard's records over its buckets. Pass two gives every bucket a Fisher-Yates
permutation of its positions; with the sizes of the buckets before it, that
makes a gapless slot in the shard. Records are then written in slot order.

A bucket's permutation follows from the seed and the number of the bucket
alone: buckets are dealt to LANES tasks by their number, each task takes its
own in order, and Spark's shuffle() is seeded by the task's number. So slots
don't depend on how the input lies, on the session's partitions or on AQE.

DataFrame functions only. Law: `key`. Defined results: null texts have size 16
and checksum 0, empty ones size 16 too; texts of any length are one record;
rows with a null id go to one shard by the hash of null; repeated rows get
slots of their own, and which of equal rows has which of their slots is left
open; ties in the order of a bucket go by id and checksum; an empty table
gives no rows; assign() replaces columns of the names that it adds, digest()
reads doc_id and text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.session import cut

SEED = 20_240_607
ROW_BYTES = 16
BUCKET_BYTES = 128 << 20  # of records that one task holds while it orders a bucket
LANES = 256  # tasks that make the permutations


def highest(doc_id: Column, shards: int, seed: int) -> Column:
    """Rendezvous hashing: the shard whose hash with the id is largest."""
    each = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(F.lit(seed), doc_id, s), s.alias("shard")))
    return F.array_max(each)["shard"]


def grown(doc_id: Column, shard: Column, shards: int, seed: int) -> Column:
    """The shard after one more was added: the new one if its hash is larger."""
    return F.when(F.xxhash64(F.lit(seed), doc_id, F.lit(shards)) > F.xxhash64(F.lit(seed), doc_id, shard), F.lit(shards)).otherwise(shard)


def assign(docs: DataFrame, shards: int = 40, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with size, text_crc32, law, shard, slot and grown_shard; columns of those names are replaced."""
    names = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "__bucket", "__mix", "__at", "__n", "__before")
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    doc_id = F.col(id_col)
    base = docs.drop(*names) if set(names) & set(docs.columns) else docs
    base = base.withColumns({"size": F.octet_length(raw).cast("long") + ROW_BYTES, "text_crc32": F.crc32(raw)})
    total = base.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))  # of each shard
    base = base.withColumn("shard", highest(doc_id, shards, seed))
    base = base.withColumn("__mix", F.xxhash64(F.lit(seed + 1), doc_id, F.col("text_crc32")))
    base = base.withColumn("__bucket", (F.col("shard") * buckets + F.pmod(F.col("__mix"), F.lit(buckets))).cast("long"))
    # sizes of the buckets, for their permutations and offsets
    sizes = cut(base.groupBy("shard", "__bucket").agg(F.count("*").alias("__n")))
    before = sizes.withColumn("__before", F.sum("__n").over(W.partitionBy("shard").orderBy("__bucket")) - F.col("__n"))
    lanes = before.repartitionById(min(LANES, shards * buckets), F.pmod("__bucket", F.lit(min(LANES, shards * buckets))).cast("int")).sortWithinPartitions("__bucket")
    perm = lanes.select("__bucket", "__before", F.posexplode(F.expr(f"shuffle(sequence(0L, __n - 1), {seed})")).alias("__at", "__to"))
    order = W.partitionBy("__bucket").orderBy("__mix", doc_id, "text_crc32")
    placed = base.withColumn("__at", F.row_number().over(order) - 1).join(perm.hint("merge"), ["__bucket", "__at"])  # perm has a row for each record: never broadcast
    placed = placed.withColumns({"law": F.lit("key"), "slot": F.col("__before") + F.col("__to"), "grown_shard": grown(doc_id, F.col("shard"), shards, seed)})
    return placed.drop("__bucket", "__mix", "__at", "__n", "__before", "__to")


def write(docs: DataFrame, path: str, shards: int = 40, **how) -> None:
    """One folder for each shard, records in slot order."""
    placed = assign(docs, shards, **how)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    return assign(docs.select("doc_id", "text"), shards).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
