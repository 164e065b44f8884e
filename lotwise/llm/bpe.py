"""BPE encoding and decoding with an automaton compiled from a merge list.

The merges are applied to an automaton one after another, in rank order. It
starts as one state with a loop for every symbol. The gadget of merge (a, b)
-> c takes arc b out of the state reached by a, and adds an arc c beside every
arc a that b could follow; the state reached by c is a copy of the state
reached by b at that time. States and arcs are kept copy-on-write: a state is
named by the token that enters it, knows the state it was copied from and the
step of that copy, and each gadget is stored once. A transition is resolved by
walking the two copy chains and is then kept in the transition table.

Every prefix of a word has one valid path through this automaton, so a word is
encoded from left to right by table lookups, and decoding emits the labels of
the arcs. Texts are cut into words first, as the tokenizer file says.

Defined results: null and empty texts encode to no ids and an empty string; a
special token's string in a text becomes that token; texts and words of any
length are encoded whole, in time linear in their length; of several paths
there is only one, so there are no ties; repeated rows get equal results; an
empty table gives no rows; further columns are kept, but for those that the
results name.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.text import small_batches

NEVER = 1 << 60
CACHE_WORDS = 300_000
CACHE_PAIRS = 2_000_000
LONG_WORD = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class MergeAutomaton:
    """Deterministic automaton over tokens; its paths are the BPE encodings."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "") -> None:
        size = max(vocab.values()) + 1
        self.suffix = suffix
        self.label = [""] * size
        for token, i in vocab.items():
            self.label[i] = token
        self.head, self.base = [-1] * size, [-1] * size  # the arc it stands beside, the state it was copied from
        self.born = [-1] * size  # step of the gadget; -1: there from the start
        self.gadget: dict[tuple[int, int], int] = {}
        self.table: dict[tuple[int, int], bool] = {}
        usable = {i for t, i in vocab.items() if len(t.removesuffix(suffix) if suffix else t) == 1}
        for step, (left, right) in enumerate(merges):
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            if self.crossing(a, b) > step and a in usable and b in usable:
                usable.add(c)
            self.head[c], self.base[c], self.born[c] = a, b, step
            self.gadget[a, b] = step
        self.inner = {t: i for t, i in vocab.items() if i in usable and not (suffix and t.endswith(suffix))}
        self.final = {t.removesuffix(suffix): i for t, i in vocab.items() if i in usable and t.endswith(suffix)} if suffix else self.inner
        self.widest = max(len(t) for t in [*self.inner, *self.final])

    def crossing(self, x: int, y: int) -> int:
        """First step whose gadget took away what is now arc y in the state after x."""
        born, first = self.born, NEVER
        tails, until = [], NEVER
        while x >= 0:
            tails.append((x, until))
            until, x = born[x], self.base[x]
        gone = NEVER
        while y >= 0:
            for t, end in tails:
                step = self.gadget.get((t, y))
                # the copy t was in place before step `end`; the leftmost pair of equal rank merges first
                if step is not None and born[t] < step < end and born[y] < step <= gone:
                    first = min(first, step)
            gone, y = born[y], self.head[y]
        return first

    def follows(self, x: int, y: int) -> bool:
        """Transition table: does the state after x have an arc y?"""
        got = self.table.get((x, y))
        if got is None:
            if len(self.table) >= CACHE_PAIRS:
                self.table.clear()
            got = self.table[x, y] = self.crossing(x, y) == NEVER
        return got

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-split word, given in the vocabulary's alphabet."""
        n, widest, inner = len(word), self.widest, self.inner
        if n == 0:
            return []
        whole = self.final.get(word)
        last, start = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            arcs = self.final if i == n else inner
            for j in range(max(0, i - widest), i):
                y = arcs.get(word[j:i])
                if y is not None and (j == 0 or (last[j] >= 0 and self.follows(last[j], y))):
                    last[i], start[i] = y, j
                    break
            if i == n and last[i] < 0 and whole is not None:
                last[i], start[i] = whole, 0
        out, i = [], n
        while i > 0:
            out.append(last[i])
            i = start[i]
        return out[::-1]


class WordBpe:
    """A lower-casing word-level BPE as described by a tokenizer JSON file."""

    def __init__(self, spec: dict) -> None:
        import regex

        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.machine = MergeAutomaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.alphabet = byte_alphabet()
        self.cache: dict[str, bytes] = {}
        self.labels = list(self.machine.label)
        for token, i in self.special.items():
            self.labels[i : i + 1] = [token] if i < len(self.labels) else [""] * (i - len(self.labels)) + [token]

    def arcs(self, word: str) -> bytes:
        """The ids of a word as little-endian uint32."""
        return np.array(self.machine.encode("".join([self.alphabet[b] for b in word.encode()])), "<u4").tobytes()

    def known(self, word: str) -> bytes:
        got = self.cache.get(word)
        if got is None:
            got = self.arcs(word)
            if len(word) <= LONG_WORD:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                self.cache[word] = got
        return got

    def split(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def ids(self, text: str | None) -> bytes:
        """All ids of a text as little-endian uint32."""
        if not text:
            return b""
        parts = []
        for piece in self.specials.split(text) if any(s in text for s in self.special) else (text,):
            if piece in self.special:
                parts.append(np.array([self.special[piece]], "<u4").tobytes())
            elif piece:
                get, known = self.cache.get, self.known
                parts += [get(w) or known(w) for w in self.split(piece)]
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs in order, joined by blanks."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def encode(self, text: str | None) -> tuple[bytes, str]:
        ids = self.ids(text)
        return ids, self.decode(ids)


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """Compiled once in each Python worker."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as f:
            _loaded[path] = WordBpe(json.load(f))
    return _loaded[path]


def encode_column(text: Column, path: str) -> Column:
    """binary: ids as little-endian uint32."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for texts in batches:
            yield pd.Series([bpe.ids(t) for t in texts], dtype=object)

    return run(text)


def decode_column(ids: Column, path: str) -> Column:
    """string: the text that the ids stand for."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for rows in batches:
            yield pd.Series([bpe.decode(i) for i in rows], dtype=object)

    return run(ids)


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """df with a column ids (binary); a column of that name is replaced.

    `path` names a tokenizer JSON that every executor can open.
    """
    small_batches(df.sparkSession)
    return df.withColumn("ids", encode_column(F.col(f"`{text_col}`"), path))


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """df with a column decoded (string); a column of that name is replaced."""
    small_batches(df.sparkSession)
    return df.withColumn("decoded", decode_column(F.col(f"`{ids_col}`"), path))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    done = decode(encode(docs.select("doc_id", "text"), path), path).select("doc_id", "ids", "decoded")
    return done.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
