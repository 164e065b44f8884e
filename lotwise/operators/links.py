"""Links among the rows of one block, worked out within a task: edges that have the components of all pairs, without the pairs.

Each function takes a block as an Arrow table and returns an edge to the smallest id of its component for each other row. Pairs
that are linked already, directly or not, are not compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lotwise.functions import geo
from lotwise.functions.similarity import token_set

CHUNK, PAIRS = 1 << 20, 1 << 14  # pairs made, and pairs of texts compared, together
REST, MOST_WORDS = 64, 32  # letters in the bits of a number, and words of a text beside its own number


def stars(ids: pa.ChunkedArray, group: np.ndarray) -> pa.Table:
    """Edges of every id to the smallest one of its group."""
    order = pc.sort_indices(ids).to_numpy()
    _, first, at = np.unique(group[order], return_index=True, return_inverse=True)
    least = np.empty(len(group), np.int64)
    least[order] = order[first][at]
    other = np.flatnonzero(least != np.arange(len(group)))
    return pa.table({"a": ids.take(pa.array(other)), "b": ids.take(pa.array(least[other]))})


def joined(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Groups once the items a and b are in one: every group takes the smallest number that it meets, until none changes."""
    while True:
        x, y = group[a], group[b]
        apart = x != y
        if not apart.any():
            return group
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        to = np.arange(len(group))
        np.minimum.at(to, np.maximum(x, y), np.minimum(x, y))
        while (to != to[to]).any():
            to = to[to]
        group = to[group]


def near(near_m: float, share: float) -> Callable[[pa.Table], pa.Table]:
    """Places (lat, lng, size, id) at most near_m apart whose sizes differ by at most `share` of the larger.

    On a grid of squares whose diagonal is near_m, with logarithmic cells of size, all places of a cell match.
    """
    side = near_m / math.sqrt(2) * 0.999 / geo.METRES_A_DEGREE

    def run(block: pa.Table) -> pa.Table:
        lat, lng, size = (block[c].to_numpy() for c in ("lat", "lng", "size"))
        cos = np.cos(np.radians([np.abs(lat).min(), min(np.abs(lat).max(), 89.9)]))
        wide = side / cos[0]
        cell = np.stack([np.floor(lat / side), np.floor(lng / wide), np.floor(np.log(size) / -math.log(1 - share))]).astype(np.int64)
        cell -= cell.min(axis=1, keepdims=True)
        reach = (2, math.ceil(near_m / geo.METRES_A_DEGREE / cos[1] / wide), 1)
        span = cell.max(axis=1) + 1 + 2 * np.array(reach)
        code = lambda c: (c[0] * span[1] + c[1]) * span[2] + c[2]
        cells, of, many = np.unique(code(cell), return_inverse=True, return_counts=True)
        order = np.argsort(of, kind="stable")
        start = np.cumsum(many) - many
        group = np.arange(len(cells))

        def match(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            x, y = size[p], size[q]
            close = np.abs(x - y) <= share * np.maximum(x, y)
            lat_p, lat_q = np.radians(lat[p]), np.radians(lat[q])
            h = np.sin(np.radians(lat[q] - lat[p]) / 2) ** 2 + np.cos(lat_p) * np.cos(lat_q) * np.sin(np.radians(lng[q] - lng[p]) / 2) ** 2
            return close & (2 * geo.EARTH_M * np.arcsin(np.sqrt(np.minimum(h, 1.0))) <= near_m)

        steps = [s for s in product(*[range(-r, r + 1) for r in reach]) if s > (0, 0, 0)]
        for step in sorted(steps, key=lambda s: sum(map(abs, s))):
            to = np.searchsorted(cells, want := cells + code(step))
            a = np.flatnonzero((to < len(cells)) & (cells[np.minimum(to, len(cells) - 1)] == want))
            b = to[a]
            while len(a):  # the pairs of cells that are still apart, some at a time
                some = group[a] != group[b]
                a, b = a[some], b[some]
                pairs = many[a] * many[b]
                n = max(1, int(np.searchsorted(np.cumsum(pairs), CHUNK, "right")))
                for low in range(0, int(pairs[:n].max(initial=0)) if n == 1 else 1, CHUNK):
                    size_ = np.minimum(pairs[:n] - low, CHUNK) if n == 1 else pairs[:n]
                    k = np.repeat(np.arange(len(size_)), size_)
                    at = np.arange(len(k)) - np.repeat(np.cumsum(size_) - size_, size_) + (low if n == 1 else 0)
                    p, q = order[start[a[k]] + at // many[b[k]]], order[start[b[k]] + at % many[b[k]]]
                    hit = np.unique(k[match(p, q)])
                    group = joined(group, a[hit], b[hit])
                    if n == 1 and len(hit):
                        break
                a, b = a[n:], b[n:]
        return stars(block["id"], group[of])

    return run


class Texts:
    """Texts as sets of words, compared many pairs at a time as similarity.token_set() does two."""

    def __init__(self, texts: list[str], least: int) -> None:
        self.least, self.words = least, [sorted(set(t.lower().split())) for t in texts]
        known = {w: i for i, w in enumerate(dict.fromkeys(w for ws in self.words for w in ws))}
        letters = {c: i for i, c in enumerate(sorted({" ", *"".join(known)}))}
        self.codes = [np.array([letters[c] for c in w], np.int64) for w in known]
        self.many = np.array([len(ws) for ws in self.words])
        self.ids = np.full((len(texts), max(1, self.many.max())), -1, np.int64)
        for i, ws in enumerate(self.words):
            self.ids[i, : len(ws)] = [known[w] for w in ws]
        self.sizes = np.array([*map(len, known), 0])  # the last one for no word
        counts = np.stack([np.bincount(c, minlength=len(letters)) for c in self.codes] + [np.zeros(len(letters), int)])
        self.bag = counts[self.ids].sum(axis=1).astype(np.int32)
        self.bag[:, letters[" "]] += np.maximum(self.many - 1, 0)
        self.length = self.bag.sum(axis=1, dtype=np.int64)
        self.bag = self.bag.astype(np.int8) if self.bag.max() < 128 else self.bag
        self.blank = letters[" "]
        self.rests: dict[tuple[int, int], int] = {}
        self.used = 0
        self.at = np.zeros((64, len(letters)), np.uint64)  # of each rest: a bit for each place of a letter
        self.rest = np.full((64, REST), -1, np.int64)

    def possible(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs may reach `least`, and which of them by the letters that their texts have in common, in order.

        These are at most as many as they have in common in any order. Else words have to be shared.
        """
        common = np.minimum(self.bag[x], self.bag[y]).sum(axis=1, dtype=np.int64)
        one, two = self.length[x], self.length[y]
        shorter = np.minimum(one, two)
        whole = 200 * common >= self.least * (one + two)
        # shared words against the shorter side; all words of a side shared
        some = whole | (200 * common >= self.least * (common + shorter)) | (common >= shorter)
        return some & (self.many[x] > 0) & (self.many[y] > 0), whole

    def similar(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        some, whole = self.possible(x, y)
        out = some.copy()
        out[some] = self.compared(x[some], y[some], whole[some])
        return out

    def compared(self, x: np.ndarray, y: np.ndarray, whole: np.ndarray) -> np.ndarray:
        equal = (self.ids[x][:, :, None] == self.ids[y][:, None, :]) & (self.ids[x] >= 0)[:, :, None]
        mine, other = equal.any(axis=2), equal.any(axis=1)
        n = mine.sum(axis=1)
        both = np.where(mine, self.sizes[self.ids[x]], 0).sum(axis=1) + np.maximum(n - 1, 0)
        one, two = self.length[x], self.length[y]
        hit = (n > 0) & ((n == self.many[x]) | (n == self.many[y]) | (200 * both >= self.least * (both + np.minimum(one, two))))
        ask = np.flatnonzero(~hit & whole)
        if len(ask) and self.ids.shape[1] <= MOST_WORDS:
            p, q = self.rests_of(x[ask], mine[ask]), self.rests_of(y[ask], other[ask])
            short = (p >= 0) & (q >= 0)
            head = both[ask] + (n[ask] > 0)
            got = np.zeros(len(ask), bool)
            got[short] = 200 * (head[short] + self.in_order(p[short], q[short])) >= self.least * (one + two)[ask[short]]
            hit[ask[short]] = got[short]
            ask = ask[~short]
        for k in ask.tolist():
            hit[k] = token_set(" ".join(self.words[x[k]]), " ".join(self.words[y[k]])) >= self.least
        return hit

    def rests_of(self, text: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Number of each text's words that are not shared; -1 if these are longer than REST."""
        marks, where = np.unique(text << MOST_WORDS | shared @ (1 << np.arange(shared.shape[1])), return_inverse=True)
        return np.array([self.rest_of(m >> MOST_WORDS, m & (1 << MOST_WORDS) - 1) for m in marks.tolist()])[where]

    def rest_of(self, text: int, bits: int) -> int:
        if (text, bits) not in self.rests:
            kept = [self.codes[w] for i, w in enumerate(self.ids[text, : self.many[text]]) if not bits >> i & 1]
            line = np.concatenate([x for c in kept for x in (c, [self.blank])])[:-1].astype(np.int64) if kept else np.zeros(0, np.int64)
            if len(line) > REST:
                self.rests[text, bits] = -1
                return -1
            k = self.used
            if k == len(self.at):
                self.at, self.rest = np.concatenate([self.at, np.zeros_like(self.at)]), np.concatenate([self.rest, np.full_like(self.rest, -1)])
            for i, c in enumerate(line.tolist()):
                self.at[k, c] |= np.uint64(1 << i)
            self.rest[k, : len(line)] = line
            self.rests[text, bits], self.used = k, k + 1
        return self.rests[text, bits]

    def in_order(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of rests; as similarity.matching(), a row of the table is one number."""
        row = np.full(len(p), ~np.uint64(0))
        for i in range(int((self.rest[q] >= 0).sum(axis=1).max(initial=0))):
            c = self.rest[q, i]
            hit = row & np.where(c >= 0, self.at[p, c], np.uint64(0))
            row = (row + hit) | (row - hit)
        return np.bitwise_count(~row).astype(np.int64)


def alike(least: int, share: float, buckets: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Texts (text, size, bucket, own, id) whose word sets reach `least`, with close sizes, one of them of the block's own cell."""

    def run(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("size")
        size, bucket, home = block["size"].to_numpy(), block["bucket"].to_numpy(), block["own"].to_numpy() == key[2].as_py()
        n = block.num_rows
        # how far the rows reach that are close in size to each row of the own cell: the rest lies behind
        until = np.searchsorted(size * (1 - share) * (1 - 1e-9), size, "right") - np.arange(n)
        until[~home] = 0
        group, texts, low, farthest = np.arange(n), None, 1, int(until.max(initial=0))
        while low < farthest and (group != group[0]).any():
            texts = texts or Texts(block["text"].to_pylist(), least)
            high = min(2 * low, low + max(1, CHUNK // n))  # rows that lie `low` to `high` apart in the order of size
            many = np.clip(np.minimum(until, high) - low, 0, None)
            i = np.repeat(np.arange(n), many)
            j = i + low + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
            low = high
            some = (np.abs(size[i] - size[j]) <= share * np.maximum(size[i], size[j])) & (np.abs(bucket[i] - bucket[j]) <= buckets)
            i, j = i[some], j[some]
            for k in range(0, len(i), PAIRS):
                x, y = i[k : k + PAIRS], j[k : k + PAIRS]
                some = group[x] != group[y]
                x, y = x[some], y[some]
                some = texts.similar(x, y)
                group = joined(group, x[some], y[some])
        return stars(block["id"], group)

    return run
