"""Language identification by rank-order profiles.

A language's profile is its most frequent letter n-grams (one to three letters, blanks at word
edges), ranked over all its training texts. A text's own most frequent n-grams are ranked the same
way, and the language with the smallest sum of rank displacements wins; an n-gram that a profile
lacks costs the profile's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import annotate, runs

#: N-grams per profile and per text.
PROFILE = 300
#: Letters of a text worked on at once.
PIECE = 1 << 20
_ALPHA: list[np.ndarray] = []


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, with one blank for each run of anything but letters."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.concatenate([[32], np.where(_alpha()[a], a, 32), [32]]).astype(np.int64)
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != 32) | (a[:-1] != 32)
    return a[keep]


def _grams(a: np.ndarray) -> np.ndarray:
    """All n-grams as integers of 21 bits a letter."""
    two = a[:-1] | a[1:] << 21
    three = two[:-1] | a[2:] << 42
    return np.concatenate([a[a != 32], two, three[a[1:-1] != 32]])


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts; long texts are counted piece by piece."""
    a = _letters(text or "")
    if len(a) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(a) <= PIECE:
        return np.unique(_grams(a), return_counts=True)
    codes, counts = [], []
    for at in range(0, len(a), PIECE):
        end = min(len(a), at + PIECE)
        own = a[at:end]
        parts = [own[own != 32], a[at:end] [: len(a[at + 1:end + 1])] | a[at + 1:end + 1] << 21]
        third = a[at + 2:end + 2]
        three = parts[1][:len(third)] | third << 42
        parts.append(three[a[at + 1:at + 1 + len(three)] != 32])
        c, n = np.unique(np.concatenate(parts), return_counts=True)
        codes.append(c)
        counts.append(n)
    return _sum(codes, counts)


def _sum(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    c, where = np.unique(np.concatenate(codes), return_inverse=True)
    return c, np.bincount(where, np.concatenate(counts), len(c)).astype(np.int64)


def _count_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(lang, c, n):
        return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(c), pa.string()),
                                           "gram": pa.array(c), "n": pa.array(n)})

    held: dict[str, tuple[list, list]] = {}
    for part in runs(batches, "text"):
        texts: dict[str, list[str]] = {}
        for t, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
            texts.setdefault(lang, []).append(t)
        for lang, own in texts.items():
            c, n = gram_counts(" ".join(own))
            codes, counts = held.setdefault(lang, ([], []))
            codes.append(c)
            counts.append(n)
            if sum(map(len, codes)) > 1_000_000:
                c, n = _sum(codes, counts)
                if len(c) > 500_000:
                    yield rows(lang, c, n)
                    held[lang] = ([], [])
                else:
                    held[lang] = ([c], [n])
    for lang, (codes, counts) in held.items():
        if codes:
            yield rows(lang, *_sum(codes, counts))


class Profiles:
    """Ranks of the profile n-grams of every language, as one small matrix."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.rank = np.full((len(self.grams) + 1, len(self.langs)), size, np.int32)
        at = {g: i for i, g in enumerate(self.grams.tolist())}
        col = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.rank[at[gram], col[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = gram_counts(text)
        if not len(codes) or not self.langs:
            return "und", 0.0
        top = np.lexsort((codes, -counts))[:self.size]
        own = codes[top]
        where = np.searchsorted(self.grams, own)
        known = np.minimum(where, len(self.grams) - 1)
        rows = self.rank[np.where(self.grams[known] == own, known, len(self.grams))]
        ranks = np.arange(len(own))[:, None]
        away = np.where(rows < self.size, np.abs(rows - ranks), self.size).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], float(1 - away[best] / (self.size * len(own)))


def fit_profiles(train: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``train`` with a language; the driver gets ``size`` rows a language."""
    counts = (train.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                           F.col(lang).cast("string").alias("lang"))
              .where(F.col("lang").isNotNull())
              .mapInArrow(_count_by_language, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    return Profiles([(r.lang, r.gram, r["rank"] - 1) for r in top.collect()], size)


def identify(df: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All columns of ``df`` (or those in ``keep``) with ``lang_pred`` and ``score`` added (columns of those names are replaced).

    ``score`` is one less the share of the largest possible displacement. Null, empty and
    letterless texts are ``und`` with score 0; equal distances take the smaller language name; equal
    n-gram counts rank by code point. Whole texts are read, whatever their length.
    """
    def setup():
        def run(texts):
            got = [profiles.predict(t) for t in texts]
            return pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())
        return run
    return annotate(df, text, setup, [("lang_pred", "string"), ("score", "double")], keep)


def accepted(min_score: float = 0.3) -> Column:
    """Documents in a language that some profile knows; only letterless or alien texts go."""
    return (F.col("lang_pred") != "und") & (F.col("score") >= min_score)
