"""Benchmark decontamination by SimHash over windows as long as the items.

Every run of words of a text as long as an item (lengths above 16 on a grid of ratio 1.5, rounded
down) gets a 64-bit SimHash of its word pairs, from running sums. Item windows are indexed by four
16-bit blocks; since two fingerprints within ``RADIUS`` bits differ by at most ``RADIUS // 4`` in
some block, looking up each block with that many flipped bits finds all of them. A hit is verified
by the exact Jaccard similarity of counted five-word shingles between item and text window.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordHash, annotate, mix64, shingle_hashes

K, THRESHOLD = 5, 0.75
RADIUS, BLOCKS = 11, 4
#: Items that travel to the tasks at once; a larger benchmark is worked off in parts.
ITEMS = 5_000
#: Words fingerprinted at once.
PIECE = 1 << 15
_CUT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None, hashes: WordHash) -> np.ndarray:
    """Hashes of a text's words: lower case, ASCII marks and blanks part words."""
    return hashes.of((text or "").lower().encode("utf-8", "surrogatepass").translate(_CUT).split())


def grid(n: int) -> int:
    """Window length for items of n words."""
    if n <= 16:
        return n
    w = 16
    while w * 3 // 2 <= n:
        w = w * 3 // 2
    return w


def _pair_bits(words: np.ndarray) -> np.ndarray:
    """64 bits of every word pair, as a row of zeros and ones."""
    with np.errstate(over="ignore"):
        pairs = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    return np.unpackbits(pairs.view(np.uint8).reshape(-1, 8), axis=1)


def _sums(bits: np.ndarray, most: int) -> np.ndarray:
    """Running counts of ones, with a first row of zeros; they may wrap, differences up to ``most`` do not."""
    kind = np.uint8 if most < 256 else np.uint32
    out = np.zeros((len(bits) + 1, 64), kind)
    np.cumsum(bits, axis=0, dtype=kind, out=out[1:])
    return out


def _fingerprints(sums: np.ndarray, pairs: int) -> np.ndarray:
    """SimHash of every window of so many word pairs."""
    ones = sums[pairs:] - sums[:-pairs]
    return np.packbits(ones > pairs // 2, axis=1).view(np.uint64).ravel()


def fingerprint(words: np.ndarray) -> int:
    if len(words) == 1:
        return int(mix64(words)[0])
    return int(_fingerprints(_sums(_pair_bits(words), len(words)), len(words) - 1)[0])


class Index:
    """Item windows of one length: fingerprints, and for each block the windows near each value."""

    def __init__(self, windows: list[tuple[int, int, int]]):
        self.fp = np.array([w[0] for w in windows], np.uint64)
        self.item, self.offset = np.array([w[1] for w in windows]), np.array([w[2] for w in windows])
        flips = np.array([sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1)
                          for c in combinations(range(16), r)], np.uint32)
        self.blocks = []
        for b in range(BLOCKS):
            value = ((self.fp >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint32)
            near = (value[:, None] ^ flips).ravel()
            order = np.argsort(near, kind="stable")
            starts = np.searchsorted(near[order], np.arange(65537))
            self.blocks.append((starts[:-1], np.diff(starts).astype(np.uint16), np.repeat(np.arange(len(value)), len(flips))[order]))

    def within(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, item window) of all pairs within the radius."""
        found = []
        halves = fps.view(np.uint16).reshape(-1, BLOCKS)
        for b, (starts, counts, ids) in enumerate(self.blocks):
            some = np.flatnonzero(counts[halves[:, b]])
            v = halves[some, b]
            n = counts[v].astype(np.int64)
            place = np.repeat(some, n)
            at = np.arange(len(place)) + np.repeat(starts[v] - (np.cumsum(n) - n), n)
            one = ids[at]
            near = np.bitwise_count(fps[place] ^ self.fp[one]) <= RADIUS
            found.append(place[near] * len(self.fp) + one[near])
        both = np.unique(np.concatenate(found))
        return both // len(self.fp), both % len(self.fp)


def similarity(a: Counter, b: Counter) -> float:
    """Jaccard similarity of counted shingles."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def _shingles(words: np.ndarray) -> Counter:
    return Counter(shingle_hashes(words, K).tolist())


class Scanner:
    """Finds the items of a benchmark part in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.hashes = WordHash()
        self.items = [(i, w) for i, w in ((i, words_of(t, self.hashes)) for i, t in items) if len(w)]
        self.shingles = [_shingles(w) for _, w in self.items]
        by: dict[int, set] = {}
        for k, (_, w) in enumerate(self.items):
            size = grid(len(w))
            for o in {(len(w) - size) // 2} if 5 * size >= 4 * len(w) else {0, len(w) - size}:
                by.setdefault(size, set()).add((fingerprint(w[o:o + size]), k, o))
        self.index = {size: Index(sorted(ws)) for size, ws in by.items()}

    def _hits(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, place where the whole item would begin) of all fingerprint hits in a run of words."""
        out: set[tuple[int, int]] = set()
        longest = max(self.index)
        for at in range(0, len(words), PIECE):
            piece = words[at:at + PIECE + longest - 1]
            sums = _sums(_pair_bits(piece), longest) if len(piece) > 1 else None
            for size, index in self.index.items():
                if len(piece) < size:
                    continue
                fps = mix64(piece) if size == 1 else _fingerprints(sums, size - 1)
                place, one = index.within(fps[:PIECE])
                out.update(zip(index.item[one].tolist(), (at + place - index.offset[one]).tolist()))
        return out

    def scan(self, texts: list[str | None]) -> list[list[dict]]:
        """The items found in each text, each at its most similar window."""
        parts = [words_of(t, self.hashes) for t in texts]
        out: list[list[dict]] = [[] for _ in texts]
        if not self.index or not parts:
            return out
        words = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        found: dict[tuple[int, int], tuple] = {}
        for k, begin in sorted(self._hits(words)):
            size = len(self.items[k][1])
            doc = int(np.searchsorted(ends, min(begin + size // 2, len(words) - 1), side="right"))
            low, high = int(ends[doc]) - len(parts[doc]), int(ends[doc])
            a, b = max(low, begin), min(high, begin + size)
            if b <= a:
                continue
            sim = similarity(self.shingles[k], _shingles(words[a:b]))
            if sim >= THRESHOLD and (-sim, a) < found.get((doc, k), (0,)):
                found[doc, k] = (-sim, a, a - low, b - a)
        for (doc, k), (sim, _, start, n) in sorted(found.items()):
            out[doc].append({"item_id": self.items[k][0], "similarity": -sim, "start": start, "words": n})
        return out


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``hits``: item_id, similarity, first word and words of each item found.

    Every window of every text is fingerprinted. Null and empty texts and items without a word have
    no hits; items under five words are one shingle. Of equal similarities the first window counts.
    Repeated rows of either table are rows of their own. An empty benchmark finds nothing. The
    benchmark is read in parts of bounded size.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where(
        "t is not null")
    parts = max(1, -(-items.count() // ITEMS))
    kind = "array<struct<item_id:bigint,similarity:double,start:bigint,words:bigint>>"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64()),
                                ("words", pa.int64())]))
    out, names = docs, []
    for p in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p)
        rows = [(r.i, r.t) for r in own.collect()]
        names.append(f"__hits{p}" if parts > 1 else "hits")

        def setup(rows=rows):
            scanner = Scanner(rows)
            return lambda texts: (pa.array(scanner.scan(texts), arrow),)
        held = None if keep is None else [*keep, *names[:-1], *([text] if p < parts - 1 and text not in keep else [])]
        out = annotate(out, text, setup, [(names[-1], kind)], held)
    return out if parts == 1 else out.withColumn("hits", F.concat(*names)).drop(*names)
