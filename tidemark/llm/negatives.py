"""Hard negatives by summaries of vector segments.

Each row stores, for equal segments of its vector, the mean and the deviation. Over a segment of L
components an inner product is L times (product of means + covariance), and the covariance lies
within plus or minus the product of deviations; summed over segments this bounds the score from
both sides. Coarser segments follow from finer ones. Pairs are bounded at one segment first; those
that cannot be an answer go, the rest meets the next finer level, and what is left is scored exactly.

Positives are the best rows of an anchor's own label. Each positive opens a window of scores for the
negatives; a row stays in play while its bounds reach into a window, and above the score that enough
rows are sure to have there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

#: Segments of the levels, coarse to fine; a vector has at most as many as components.
LEVELS = (1, 4, 16)
#: Vectors in a chunk, anchors in a block, anchors bounded at once.
CHUNK, BLOCK, STRIDE = 8192, 4096, 128
_ROW = "id long, label long, asks boolean, v array<long>, mean array<double>, dev array<double>"


def _cuts(dim: int, segments: int) -> np.ndarray:
    """Where segments begin and end; coarser cuts are among the finer ones."""
    finest = min(dim, LEVELS[-1])
    fine = np.arange(finest + 1) * dim // max(1, finest)
    return fine[np.arange(min(segments, finest) + 1) * finest // max(1, min(segments, finest))]


def summarize(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the finest segments of each row."""
    cuts = _cuts(v.shape[1], LEVELS[-1])
    size, x = np.diff(cuts), v.astype(np.float64)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
    off = x - np.repeat(mean, size, axis=1)
    return mean, np.sqrt(np.add.reduceat(off * off, cuts[:-1], axis=1) / size)


class Summaries:
    """Segment means and deviations of some rows at all levels, each times the root of the segment's length."""

    def __init__(self, dim: int, mean: np.ndarray, dev: np.ndarray):
        fine = _cuts(dim, LEVELS[-1])
        size = np.diff(fine)
        self.levels = []
        for s in LEVELS:
            cuts = _cuts(dim, s)
            starts, long_ = np.searchsorted(fine, cuts[:-1]), np.diff(cuts)
            m = np.add.reduceat(mean * size, starts, axis=1) / long_
            square = np.add.reduceat((dev ** 2 + mean ** 2) * size, starts, axis=1) / long_
            root = np.sqrt(long_)
            self.levels.append((m * root, np.sqrt(np.maximum(square - m * m, 0)) * root))
        m, d = self.levels[-1]
        self.norm = np.sqrt((m * m + d * d).sum(axis=1))

    def take(self, rows) -> Summaries:
        out = object.__new__(Summaries)
        out.levels, out.norm = [(m[rows], d[rows]) for m, d in self.levels], self.norm[rows]
        return out


def bounds(a: Summaries, b: Summaries, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and most inner product of every pair of rows; rounding is allowed for."""
    (ma, da), (mb, db) = a.levels[level], b.levels[level]
    middle, reach = ma @ mb.T, da @ db.T
    # One level's roots of differences of squares are off by up to the root of the double's precision.
    reach += 1e-6 * np.outer(a.norm, b.norm) + 1e-6
    return middle - reach, middle + reach


def _kth(x: np.ndarray, k: int) -> float:
    """The k-th largest, or nothing to hold against if there are fewer."""
    return float(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else -np.inf


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, len(q))
    kind = np.float64 if top < 2 ** 53 else np.int64
    return (v.astype(kind) @ q.astype(kind)).astype(np.int64)


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


class Search:
    """One block of anchors against one chunk of rows."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        self.ids, self.labels, self.v, self.summary = _columns(rows)
        self.a_ids, self.a_labels, self.a_v, self.a_summary = _columns(anchors)
        self.scored = 0

    def _sets(self, same: bool):
        """(anchors at once, rows of the same or of other labels, coarsest bounds)."""
        for y in np.unique(self.a_labels).tolist():
            rows = np.flatnonzero((self.labels == y) == same)
            own = self.summary.take(rows)
            if not len(rows):
                continue
            mine = np.flatnonzero(self.a_labels == y)
            for at in range(0, len(mine), STRIDE):
                some = mine[at:at + STRIDE]
                low, high = bounds(self.a_summary.take(some), own, 0)
                for i, a in enumerate(some.tolist()):
                    yield a, rows, low[i], high[i]

    def _refined(self, a: int, rows: np.ndarray, low: np.ndarray, high: np.ndarray, stay):
        """The rows that ``stay(low, high)`` keeps at every level, with exact scores."""
        one = self.a_summary.take([a])
        for level in range(len(LEVELS)):
            if level:
                low, high = (x[0] for x in bounds(one, self.summary.take(rows), level))
            rows = rows[stay(low, high)]
            if not len(rows):
                break
        self.scored += len(rows)
        return rows, _exact(self.a_v[a], self.v[rows])

    def positives(self, k: int):
        """(anchor, row, score) of the k best rows of the anchor's label."""
        for a, rows, low, high in self._sets(True):
            other = self.ids[rows] != self.a_ids[a]
            rows, low, high = rows[other], low[other], high[other]
            # The rows of the best upper bounds, scored, give a floor that the bounds alone would not.
            some = np.argpartition(-high, k - 1)[:k] if len(rows) > k else np.arange(len(rows))
            floor = _kth(_exact(self.a_v[a], self.v[rows[some]]).astype(float), k)
            self.scored += len(some)
            rows, score = self._refined(a, rows, low, high, lambda lo, hi: hi >= max(floor, _kth(lo, k)))
            best = _first(score, self.ids[rows], k)
            yield np.full(len(best), a), rows[best], score[best]

    def negatives(self, k: int, windows: list):
        """(anchor, window, row, score) of the k best rows of other labels in each (low, high) window of scores."""
        for a, rows, low, high in self._sets(False):
            spans = windows[a]

            def stay(lo, hi):
                keep = np.zeros(len(lo), bool)
                for w in spans:
                    sure = lo[(lo >= w["low"]) & (hi <= w["high"])]
                    keep |= (hi >= max(w["low"], _kth(sure, k))) & (lo <= w["high"])
                return keep
            rows, score = self._refined(a, rows, low, high, stay)
            for i, w in enumerate(spans):
                inside = np.flatnonzero((score >= w["low"]) & (score <= w["high"]))
                best = inside[_first(score[inside], self.ids[rows[inside]], k)]
                yield np.full(len(best), a), np.full(len(best), i), rows[best], score[best]


def _matrix(t: pa.Table, name: str) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in t.column(name).chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)


def _columns(t: pa.Table):
    v = _matrix(t, "v")
    return (t.column("id").to_numpy(), t.column("label").to_numpy(), v,
            Summaries(v.shape[1], _matrix(t, "mean"), _matrix(t, "dev")))


def _joined(parts: list[tuple], names: list[str]) -> pa.Table:
    return pa.table({n: pa.array(np.concatenate([p[i] for p in parts]) if parts else [], pa.int64())
                     for i, n in enumerate(names)})


def _positives(k: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return _joined([], ["anchor_id", "positive_id", "positive_score"])
        s = Search(anchors, rows)
        return _joined([(s.a_ids[a], s.ids[r], x) for a, r, x in s.positives(k)],
                       ["anchor_id", "positive_id", "positive_score"])
    return task


def _negatives(k: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        if not anchors.num_rows or not rows.num_rows:
            return _joined([], names)
        s, windows = Search(anchors, rows), anchors.column("windows").to_pylist()
        out = []
        for a, w, r, x in s.negatives(k, windows):
            own = [windows[i][j] for i, j in zip(a.tolist(), w.tolist())]
            out.append((s.a_ids[a], np.array([o["id"] for o in own], np.int64),
                        np.array([o["score"] for o in own], np.int64), s.ids[r], x))
        return _joined(out, names)
    return task


def _summaries(batches):
    for b in batches:
        ends = pc.list_value_length(b.column("v")).to_numpy(zero_copy_only=False)
        means, devs = [None] * b.num_rows, [None] * b.num_rows
        for dim in np.unique(ends).tolist():
            rows = np.flatnonzero(ends == dim)
            m, d = summarize(b.column("v").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim))
            for i, x, y in zip(rows.tolist(), m, d):
                means[i], devs[i] = x, y
        kind = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(means, kind), pa.array(devs, kind)],
                                         names=[*b.schema.names, "mean", "dev"])


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         vec_id: str = "vec_id", vector: str = "vector", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector`` is array<long> or null. An anchor's positives are its best other rows of its label;
    the negatives of a pair are the best rows of other labels with a score from ``low`` to ``high``
    per cent of the positive's, which for a negative positive score is none. Ties go to the smaller
    id. Rows with a null id, label or vector and empty vectors take no part; a repeated id counts
    once, with its least label and vector; vectors of different lengths have no score. Fewer rows
    than asked for give them all, an empty table none. Other columns are left aside.
    """
    rows = (vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                           F.col(vector).alias("v"), F.coalesce(anchors, F.lit(False)).alias("asks"))
            .where("id is not null and label is not null and v is not null and size(v) > 0")
            .groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("asks").alias("asks"))
            .select("id", F.col("r.label").alias("label"), "asks", F.col("r.v").alias("v")))
    rows = materialize(rows.mapInArrow(_summaries, _ROW).withColumn("dim", F.size("v")), "negatives-summaries")
    n, q = rows.agg(F.count("*"), F.count_if("asks")).first()
    chunks, blocks = -(-max(1, n) // CHUNK), -(-max(1, q) // BLOCK)
    dealt = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    keys, own = ["dim", "chunk", "block"], ["id", "label", "v", "mean", "dev"]
    stored = rows.withColumn("chunk", dealt(chunks)).withColumn("block", every(blocks)).select(*keys, *own)
    asked = rows.where("asks").withColumn("block", dealt(blocks)).withColumn("chunk", every(chunks)).select(*keys, *own)

    def meet(left: DataFrame, task, schema: str) -> DataFrame:
        # Both sides come from one frame; aliases keep their columns apart.
        right = stored.select(*[F.col(c).alias(c) for c in stored.columns])
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(task, schema)

    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    pairs = (meet(asked, _positives(positives), "anchor_id long, positive_id long, positive_score long")
             .withColumn("__rank", F.row_number().over(best)).where(F.col("__rank") <= positives))
    # Whole-number edges of the windows: low * p <= 100 * n <= high * p.
    floor = lambda x: F.expr(f"({x} - pmod({x}, 100L)) div 100L")
    edges = F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"),
                     floor(f"({low} * positive_score + 99L)").alias("low"), floor(f"({high} * positive_score)").alias("high"))
    windows = pairs.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(edges).alias("windows"))
    found = meet(asked.join(windows, "id").select(*keys, *own, "windows"), _negatives(negatives),
                 "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    per = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
