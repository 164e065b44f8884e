"""Cross-entropy difference between two matched n-gram language models.

One vocabulary, every word that all documents together hold at least twice, is
shared by a target model (documents marked as wanted) and a background model
(all documents). Both are bigram models of the same form: bigram counts
smoothed with the unigram distribution, unigrams with one added count. The
background's counts are scaled to the number of tokens of the target, so both
speak from the same amount of evidence. A document is scored without itself:
its own counts are taken out of each model that saw it. Counts cover every
document, word and bigram, so they grow with the input; they are kept in
buckets by key and never collected or broadcast. A document's score is the
mean over its tokens of the target loss minus the background loss, in bits:
negative scores are closer to the target.

Documents are packed into chunks of numbered words. A chunk asks for each key
it holds once (its words and ids first, then its unigrams, histories and
bigrams), with its own counts; a bucket adds up what all chunks say about its
keys and answers each of them. A frequent key is one entry a chunk, so no
bucket is larger for it. Words and bigrams are known by 64-bit hashes.

Defined results: null and empty texts have no tokens and null losses and
scores; texts and words of any length count whole (a text lies in one chunk,
at about 40 bytes a word); words outside the vocabulary are one token of it;
without target documents both models are uniform over the vocabulary and
scores are 0; repeated rows and ties get equal scores, and each row sees the
other ones; an empty table gives no rows; a null id never marks a target;
further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.text import small_batches
from lotwise.session import discard, place, stored

LEAST = 2  # occurrences of a word of the vocabulary
SMOOTH = 64.0  # weight of the unigram distribution, in counts: where the loss of unseen texts is lowest for a small target
CHUNK_TOKENS = 1 << 20
CHUNK_DOCS = 1 << 18
BUCKET_BYTES = 12 << 20  # of text, whose keys a bucket holds
START, UNKNOWN = 0, 1  # ids of a text's start and of all unknown words; hashes of words are larger
UNIGRAM, HISTORY, TOTAL = 0x6A09E667F3BCC908, 0xBB67AE8584CAA73B, 0x3C6EF372FE94F82B  # in place of a bigram's second word
PACKED = "chunk long, bucket long, body binary, extra binary, n long"


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def word_hash(word: bytes) -> int:
    x = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return x if x > UNKNOWN else x + 2


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(first: np.ndarray, second: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(first + np.uint64(0x9E3779B97F4A7C15)) + np.asarray(second, np.uint64))


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, as many as the largest number needs."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, np.uint64)
        wide = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()
        body = pa.compress(planes, codec="zstd", asbytes=True) if planes else b""
        out.append(np.array([len(a), wide, len(body)], np.int64).tobytes() + body)
    return b"".join(out)


def unpack(body: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(body):
        n, wide, size = (int(x) for x in np.frombuffer(body, np.int64, 3, at))
        at += 24
        a = np.zeros((n, 8), np.uint8)
        if size:
            planes = pa.decompress(body[at : at + size], n * wide, codec="zstd", asbytes=True)
            a[:, :wide] = np.frombuffer(planes, np.uint8).reshape(wide, n).T
        out.append(a.view(np.uint64).reshape(n))
        at += size
    return out


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and steps."""
    return pack(keys[:1], np.diff(keys))


def unpack_keys(first: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([first, steps]), dtype=np.uint64)


def asked(chunk: int, keys: np.ndarray, buckets: int, offset: int, *values: np.ndarray) -> pd.DataFrame:
    """A row for every bucket that the chunk has keys of: sorted keys and their values."""
    number = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    at = np.searchsorted(number, np.arange(buckets + 1, dtype=np.uint64))
    rows = [(chunk, offset + k, pack_keys(keys[lo:hi]), pack(*[v[lo:hi] for v in values]), 0) for k, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)) if hi > lo]
    return pd.DataFrame(rows, columns=["chunk", "bucket", "body", "extra", "n"])


def added(keys: list[np.ndarray], values: list[list[np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """(sums of each value by distinct key, the distinct key of each entry)."""
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return [np.bincount(at, np.concatenate(v), len(found)).astype(np.uint64) for v in zip(*values, strict=True)], at


def answers(rows: pd.DataFrame, cap: int | None) -> pd.DataFrame:
    """The sums over all chunks of each chunk's keys, at most `cap` where that is all that matters; n: keys that reach it."""
    keys, values = [unpack_keys(*unpack(b)) for b in rows["body"]], [unpack(b) for b in rows["extra"]]
    sums, at = added(keys, values)
    reach = int((sums[0] >= cap).sum()) if cap else 0
    sums = [np.minimum(s, np.uint64(cap)) if cap else s for s in sums]
    ends = np.cumsum([len(k) for k in keys])
    out = [(c, b, pack(*[s[at[hi - len(k) : hi]] for s in sums]), b"", reach) for c, b, k, hi in zip(rows["chunk"], rows["bucket"], keys, ends, strict=True) if c >= 0]
    return pd.DataFrame(out, columns=["chunk", "bucket", "body", "extra", "n"])


def chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed documents (bucket -1) and what they ask: counts of words, and ids that may be marked (buckets from `buckets`)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number: dict[bytes, int] = {}
        ids: list = []
        texts: list[np.ndarray] = []
        made = waiting = 0
        first = TaskContext.get().partitionId() << 32

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal made, waiting
            if not ids:
                return
            chunk = first + made
            words = np.concatenate(texts)
            hashes, place = np.unique(np.fromiter(map(word_hash, number), np.uint64, len(number)), return_inverse=True)
            words = place[words] if len(words) else words
            count = np.bincount(words, minlength=len(hashes))
            order = np.argsort(-count, kind="stable")  # frequent words get small numbers
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            null = np.array([i is None for i in ids])
            named = np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64)
            body = pack(hashes[:1], np.diff(hashes), order, rank[words] if len(words) else words, [len(t) for t in texts], named, null)
            yield pd.DataFrame([(chunk, -1, body, b"", 0)], columns=["chunk", "bucket", "body", "extra", "n"])
            yield asked(chunk, hashes[hashes > UNKNOWN], buckets, 0, count[hashes > UNKNOWN])
            keys = np.unique(mixed(named[~null]))
            yield asked(chunk, keys, buckets, buckets, np.zeros(len(keys)))
            number.clear(), ids.clear(), texts.clear()
            made, waiting = made + 1, 0

        for batch in batches:
            for i, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
                w = tokens(text)
                texts.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int64, len(w)))
                ids.append(None if i is pd.NA else int(i))
                waiting += len(w)
                if waiting >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                    yield from flush()
        yield from flush()

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, PACKED)


def marks(wanted: DataFrame, buckets: int) -> DataFrame:
    """The target ids, as entries of no chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            keys = np.unique(mixed(np.concatenate(held).astype(np.int64).view(np.uint64)))
            held.clear()
            return asked(-1, keys, buckets, buckets, np.full(len(keys), LEAST))

        for batch in batches:
            held.append(batch["doc_id"].to_numpy())
            if sum(map(len, held)) >= 1 << 20:
                yield flush()
        if held:
            yield flush()

    return wanted.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).mapInPandas(run, PACKED)


class Chunk:
    """A chunk's documents in words of the vocabulary, and the keys of what its scores need."""

    def __init__(self, body: bytes, known: np.ndarray, marked: np.ndarray) -> None:
        first, steps, order, words, self.lengths, ids, null = unpack(body)
        hashes = unpack_keys(first, steps)
        self.ids, self.null = ids.view(np.int64), null.astype(bool)
        self.lengths = self.lengths.astype(np.int64)
        named = np.unique(mixed(ids[~self.null]))
        self.target = np.zeros(len(ids), bool)
        self.target[~self.null] = marked[np.searchsorted(named, mixed(ids[~self.null]))] if len(named) else False
        mine = hashes.copy()
        mine[hashes > UNKNOWN] = np.where(known, hashes[hashes > UNKNOWN], np.uint64(UNKNOWN))
        self.words, place = np.unique(np.concatenate([np.array([START], np.uint64), mine]), return_inverse=True)
        self.word = place[1:][order.astype(np.int64)[words.astype(np.int64)]] if len(words) else np.zeros(0, np.int64)
        self.before = np.concatenate([[0], self.word[:-1]]) if len(words) else self.word
        starts = np.cumsum(self.lengths) - self.lengths
        self.before[starts[self.lengths > 0]] = 0  # START has the smallest id
        self.bigrams, self.bigram = np.unique(self.before * len(self.words) + self.word, return_inverse=True)
        h, w = np.divmod(self.bigrams, len(self.words))
        self.history, self.unigram = h, w
        keys = np.concatenate([pair_keys(self.words[h], self.words[w]), pair_keys(self.words, UNIGRAM), pair_keys(self.words, HISTORY), pair_keys(np.zeros(1, np.uint64), TOTAL)])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def counts(self) -> list[np.ndarray]:
        """Target and all counts, in the order of the keys."""
        out = []
        for at in (np.repeat(self.target, self.lengths), np.ones(len(self.word), bool)):
            n = len(self.words)
            parts = [np.bincount(self.bigram[at], minlength=len(self.bigrams)), np.bincount(self.word[at], minlength=n), np.bincount(self.before[at], minlength=n), [at.sum()]]
            out.append(np.concatenate(parts)[self.order])
        return out

    def own(self, of: np.ndarray, kinds: int) -> np.ndarray:
        """How often each token's bigram, word or history stands in its own text."""
        _, at, many = np.unique(self.doc * kinds + of, return_inverse=True, return_counts=True)
        return many[at]

    def losses(self, target: np.ndarray, background: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Loss of every token under both models, its own text left out."""
        n = len(self.words)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        own = [self.own(self.bigram, max(1, len(self.bigrams))), self.own(self.word, n), self.own(self.before, n), self.lengths[self.doc]]
        out, totals = [], []
        for sums, saw in ((target, self.target[self.doc]), (background, True)):
            at = np.empty(len(sums))
            at[self.order] = sums
            seen, unigrams, histories, total = np.split(at, np.cumsum([len(self.bigrams), n, n]))
            totals.append(total[0])
            scale = min(1.0, totals[0] / max(1.0, total[0]))
            bigram, word, before, all_ = (scale * (c - o * saw) for c, o in zip((seen[self.bigram], unigrams[self.word], histories[self.before], total[0]), own, strict=True))
            out.append(-np.log2((bigram + SMOOTH * (word + 1.0) / (all_ + size)) / (before + SMOOTH)))
        return out[0], out[1]


def joined(rows: pd.DataFrame, values: int) -> list[np.ndarray]:
    """A chunk's answers in the order of its keys, so many values for each."""
    parts = [unpack(b) for b in rows.sort_values("bucket")["body"]]
    return [np.concatenate([np.zeros(0, np.uint64), *[p[k] for p in parts]]) for k in range(values)]


def in_groups(rows: DataFrame, key: str, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    return rows.groupBy(key).applyInPandas(run, schema)


def score(docs: DataFrame, wanted: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_tokens, target_bits, background_bits, score of every document. wanted: doc_id of the target documents.

    What the steps hand on is written to the shared folder, and goes as soon as it has been read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes))
    where = place(spark, "lm-score")
    chunks(docs, buckets).withColumn("asks", F.col("bucket") >= 0).write.partitionBy("asks").parquet(f"{where}/chunks")  # chunks have to stay the same between the steps
    packed = spark.read.schema(f"{PACKED}, asks boolean").parquet(f"{where}/chunks")
    texts, asks = (packed.filter(c).drop("asks") for c in ("NOT asks", "asks"))

    def count_words(rows: pd.DataFrame) -> pd.DataFrame:
        return answers(rows, LEAST)

    def ask_bigrams(rows: pd.DataFrame) -> pd.DataFrame:
        """What the chunk asks, and its known words and marked ids for the last step."""
        body, said = rows[rows["bucket"] == -1], rows[rows["bucket"] >= 0]
        known, marked = (joined(said[of], 1)[0] >= LEAST for of in (said["bucket"] < buckets, said["bucket"] >= buckets))
        chunk, name = Chunk(body["body"].iloc[0], known, marked), int(body["chunk"].iloc[0])
        own = pd.DataFrame([(name, -1 - name, pack(known, marked), b"", 0)], columns=["chunk", "bucket", "body", "extra", "n"])
        return pd.concat([own, asked(name, chunk.keys, buckets, 0, *chunk.counts())])

    def count_bigrams(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] >= 0:
            return answers(rows, None)
        return rows.assign(bucket=-2)

    def losses(rows: pd.DataFrame) -> pd.DataFrame:
        of = {int(b): x for b, x in rows[rows["bucket"] < 0].set_index("bucket").iterrows()}
        known, marked = (x.astype(bool) for x in unpack(of[-2]["body"]))
        chunk = Chunk(of[-1]["body"], known, marked)
        full = chunk.lengths > 0
        t, b = chunk.losses(*joined(rows[rows["bucket"] >= 0], 2), size)
        out = pd.DataFrame({"doc_id": pd.array(chunk.ids, "Int64"), "n_tokens": chunk.lengths})
        out.loc[chunk.null, "doc_id"] = pd.NA
        for name, x in (("target_bits", t), ("background_bits", b), ("score", t - b)):
            mean = np.bincount(chunk.doc, x, len(full)) / np.maximum(chunk.lengths, 1)
            out[name] = pd.array(mean, "Float64")
            out.loc[~full, name] = pd.NA
        return out

    known = stored(in_groups(asks.unionByName(marks(wanted, buckets)), "bucket", count_words, PACKED), f"{where}/known")
    discard(spark, f"{where}/chunks/asks=true")
    # words of the vocabulary, and the start and all unknown words
    size = 2 + (known.filter(F.col("bucket") < buckets).groupBy("bucket").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] or 0)
    sums = stored(in_groups(in_groups(texts.unionByName(known), "chunk", ask_bigrams, PACKED), "bucket", count_bigrams, PACKED), f"{where}/sums")
    discard(spark, f"{where}/known")
    return in_groups(texts.unionByName(sums), "chunk", losses, "doc_id long, n_tokens long, target_bits double, background_bits double, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Target: the documents labelled good; a document with several labels has to be good in all."""
    good = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    return score(docs, good)
