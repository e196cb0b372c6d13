"""Ranked lexical search, term at a time, with a limited set of accumulators.

Every text is read once and leaves only what the items ask for: its length, and how often each term
of an item occurs in it. Counts of the whole table fix a term's weight. Then tasks go over chunks of
documents: an item's terms are worked off rarest first, each adding its share to the accumulators of
the documents that hold it. As soon as the most that the remaining terms can add is below the k-th
partial score (or the k-th score of earlier chunks of the task), no document without an accumulator
can enter, so none is opened any more and the survivors alone are updated, exactly. A task hands on
k documents an item; the best of all tasks are the result. Items are worked off in blocks of bounded
text, so neither the driver nor a task holds more of them than one block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize, scratch_dir
from .common import raw, runs

#: Item text in one block (the longest item at least).
BLOCK_BYTES = 8 << 20
#: Documents and postings that a chunk holds.
CHUNK, POSTINGS = 16_384, 2_000_000
#: Parts into which the lists of one item are dealt before the last ranking.
SPREAD = 64
#: Bytes that part terms become blanks; A-Z become a-z; all others stay.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased."""
    return text.translate(_TERMS).split()


class Item(NamedTuple):
    """An item's distinct terms, rarest first, and how often it repeats each."""

    item_id: int | None
    terms: np.ndarray
    repeats: np.ndarray


_POSTED = "doc_id long, n long, terms array<int>, tf array<int>"


def _reader(vocabulary: dict[bytes, int]):
    """Turns texts into (doc_id, number of terms, item terms held, their occurrences)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for part in runs(batches, "text"):
            ids, n, terms, tf, ends = [], [], [], [], [0]
            for key, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                held = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
                one, many = np.unique(held[held >= 0], return_counts=True)
                ids.append(key)
                n.append(len(words))
                terms.append(one)
                tf.append(many.astype(np.int32))
                ends.append(ends[-1] + len(one))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                np.concatenate(x) if x else np.zeros(0, np.int32), pa.int32())) for x in (terms, tf)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "tf"])
    return read


class Chunk:
    """Postings of some documents by term: places of the documents and what each term adds to them."""

    def __init__(self, n: np.ndarray, terms: np.ndarray, tf: np.ndarray, ends: np.ndarray, weight: np.ndarray,
                 documents: int, length: int):
        self.size = len(n)
        m = 75 + 25 * n * documents // length
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        terms, self.doc, tf = terms[order], doc[order], tf[order].astype(np.int64)
        self.adds = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * m[self.doc]))
        self.at = np.searchsorted(terms, np.arange(len(weight) + 1))
        self.most = np.zeros(len(weight), np.int64)
        some = np.flatnonzero(np.diff(self.at))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.adds, self.at[some])

    def scores(self, item: Item, k: int, floor: int) -> tuple[np.ndarray, int]:
        """Accumulators after all terms, and after how many terms no more were opened.

        Exact for every document that can be among the k best and reach ``floor``; others may be low.
        """
        rest = np.append(np.cumsum((item.repeats * self.most[item.terms])[::-1])[::-1], 0)
        acc, alive, opened = np.zeros(self.size, np.int64), None, len(item.terms)
        for i, (t, q) in enumerate(zip(item.terms.tolist(), item.repeats.tolist())):
            if alive is None and (rest[i] < floor or self._closed(acc, k, rest[i])):
                alive, opened = acc > 0, i
                if not alive.any():
                    break
            a, b = self.at[t], self.at[t + 1]
            if a == b:
                continue
            doc, adds = self.doc[a:b], self.adds[a:b]
            if alive is not None:
                here = alive[doc]
                doc, adds = doc[here], adds[here]
            acc[doc] += q * adds
        return acc, opened

    def _closed(self, acc: np.ndarray, k: int, rest: int) -> bool:
        """Whether what is left is below the k-th partial score."""
        if self.size < k or rest >= acc.max():
            return False
        return bool(rest < np.partition(acc, self.size - k)[self.size - k])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = min(at + CHUNK, max(at + 1, int(np.searchsorted(ends, base + POSTINGS, side="right"))))
            yield batch.slice(at, upto - at)
            at = upto


def _searcher(items: list[Item], weight: np.ndarray, documents: int, length: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in items]  # (-score, id is null, id), best first
        for part in _chunks(batches):
            flat = [part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "tf")]
            ends = np.append(0, np.cumsum(pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False)))
            chunk = Chunk(part.column("n").to_numpy(), *flat, ends, weight, documents, length)
            missing = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = part.column("doc_id").fill_null(0).to_numpy()
            for best, item in zip(held, items):
                floor = -best[-1][0] if len(best) == k else 1
                acc, _ = chunk.scores(item, k, floor)
                near = np.flatnonzero(acc >= floor)
                if len(near) > k:
                    least = np.partition(acc[near], len(near) - k)[len(near) - k]
                    near = near[acc[near] >= least]
                    near = near[np.lexsort((ids[near], missing[near], -acc[near]))[:k]]
                if len(near):
                    best += zip((-acc[near]).tolist(), missing[near].tolist(), ids[near].tolist())
                    best.sort()
                    del best[k:]
        rows = [(item.item_id, None if gone else i, -s) for best, item in zip(held, items) for s, gone, i in best]
        for at in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[at:at + 50_000])],
                                             names=["item_id", "doc_id", "score"])
    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item; the lists of an item are cut in parts first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = found.withColumn("__part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    first = Window.partitionBy("item_id", "__part").orderBy(*order)
    last = Window.partitionBy("item_id").orderBy(*order)
    return (some.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).drop("__part")
            .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def _block(texts: DataFrame, rows: list, k: int) -> DataFrame:
    """Best documents of one block of items, as a frame over written postings."""
    counted = [(r.item_id, Counter(terms_of(r.text.encode()))) for r in rows]
    vocabulary: dict[bytes, int] = {}
    for _, c in counted:
        for t in c:
            vocabulary.setdefault(t, len(vocabulary))
    posted = materialize(texts.mapInArrow(_reader(vocabulary), _POSTED), "lexical-postings")
    documents, length = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in posted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():
        df[r.t] = r.n
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    items = []
    for i, c in counted:
        terms = np.array([vocabulary[t] for t in c], np.int64)
        order = np.lexsort((terms, df[terms]))
        items.append(Item(i, terms[order], np.array(list(c.values()), np.int64)[order]))
    return _ranked(posted.mapInArrow(_searcher(items, weight, documents, max(1, length), k),
                                     "item_id long, doc_id long, score long"), k)


def rank(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of each item, of those with a score above 0.

    Every document row is one document; without terms (null, empty, marks only) it takes no part. A
    null document id is returned as null, after the others of its score. An item id given more than
    once counts once, with the smallest of its texts; a null item id is one item; an item without
    terms, or whose terms no document holds, has no rows. Ties go to the smaller document id. An empty
    table on either side gives no rows. Very long texts are read whole. Other columns are left aside.
    """
    asked = (items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
             .where("text is not null").groupBy("item_id").agg(F.min("text").alias("text")))
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), raw(F.col(text)).alias("text"))
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    if blocks == 1:
        return _block(texts, asked.collect(), k)
    spark, out = docs.sparkSession, scratch_dir(docs.sparkSession, "lexical-blocks")
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        _block(texts, rows, k).write.parquet(f"{out}/block={b}")
    return spark.read.parquet(out).select("item_id", "rank", "doc_id", "score")
