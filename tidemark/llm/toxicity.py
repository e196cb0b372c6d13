"""Toxicity by compression distance.

zstandard dictionaries are trained on toxic and on ordinary text. A window is a word with its blanks;
its distance is how many bytes fewer it takes under the toxic dictionary than under an ordinary one.
A short window pays off because a fixed carrier, with which every dictionary ends, precedes it, so
that it is never stored raw, and a fixed tail follows it, since the compressor looks for no match in
the last bytes of its input. A document's score comes from the number of windows over each of several
distances, the largest distance and the number of all windows.

Most of a toxic text is ordinary. So the toxic dictionary is trained in rounds: windows that are at
least ``RATIO`` times as frequent in toxic texts as in ordinary ones are dealt to two halves by their
text's key; each half trains a dictionary, and keeps those of its windows that the other half's
dictionary shortens. Accidents of one half are not confirmed by the other, stems with many endings are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import annotate, ascii_words, runs

#: Labelled rows of each class that the fit reads at most.
FIT_ROWS = 8_000
#: How many times as frequent in toxic texts a window is that may enter the toxic dictionary.
RATIO = 10
#: Bytes of the toxic dictionary, and of the ordinary ones, against each of which distances are taken.
TOXIC, ORDINARY = 8192, (8192, 65536)
#: (dictionary bytes, segment bytes) by which the halves confirm each other; what any of them keeps stays.
ROUNDS, CONFIRMED_BY = 3, ((1024, 12), (2048, 12), (2048, 16))
#: Bytes that a dictionary has to save for a window to be confirmed.
SAVES = 3
#: Distances at which the windows of a document are counted.
LEVELS = (2, 3, 4, 5, 6)
#: Bytes of a dictionary's segments and of the parts whose frequency the trainer counts; windows in one sample.
SEGMENT, PART, SAMPLE = 12, 6, 60
#: Entries of a counter that a fit task holds before it hands them on.
HELD = 1_000_000
#: Bytes that texts do not hold: before a window, and after it.
CARRIER, TAIL = bytes([*range(1, 9), *range(14, 31)]), bytes([0xF8, 0xFF, 0xF9, 0xFE, 0xFA, 0xFD, 0xFB, 0xFC, 0xF5])
REMEMBERED = 400_000


def _compressor(content: bytes):
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, window_log=18,
        hash_log=17, chain_log=17, search_log=6, min_match=3, target_length=64, strategy=zstandard.STRATEGY_GREEDY)
    one = zstandard.ZstdCompressionDict(content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    one.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=one, compression_params=params).compress


def _dictionary(windows: dict[bytes, int], size: int, segment: int = SEGMENT) -> bytes:
    """A dictionary trained on windows, each as often as given; what fits in stands as it is, the most frequent last."""
    whole = b" " + b" ".join(sorted(windows, key=lambda w: (windows[w], w))) + b" "
    if len(whole) <= size:
        return whole
    each = [w for w in sorted(windows) for _ in range(windows[w])]
    np.random.default_rng(1).shuffle(each)
    samples = [b" " + b" ".join(each[i:i + SAMPLE]) + b" " for i in range(0, len(each), SAMPLE)]
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=PART, level=3).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return whole[-size:]


class _Length(dict):
    """Compressed bytes of a window under one dictionary, remembered."""

    def __init__(self, content: bytes):
        super().__init__()
        self.compress = _compressor(content)

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self.compress(CARRIER + b" " + word[:64] + b" " + TAIL))
        return value


def _confirmed(halves: tuple[dict, dict], ordinary: bytes) -> dict[bytes, int]:
    """The windows of each half that the other half's dictionary shortens, with their counts."""
    usual, out = _Length(ordinary), Counter()
    for size, segment in CONFIRMED_BY:
        kept = halves
        for _ in range(ROUNDS):
            own = [_Length(_dictionary(h, size, segment)) for h in kept]
            # Windows that went in an earlier round are tried again.
            kept = tuple({w: n for w, n in h.items() if usual[w] - other[w] >= SAVES} for h, other in zip(halves, own[::-1]))
        out |= Counter(kept[0]) + Counter(kept[1])
    return out


class Distance(dict):
    """Bytes that a window saves under the toxic dictionary against each ordinary one, remembered for frequent windows."""

    def __init__(self, toxic: bytes, ordinary: tuple[bytes, ...]):
        super().__init__()
        self.toxic, self.ordinary = _compressor(toxic), [_compressor(d) for d in ordinary]

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        # A very long word is many windows; its best one counts.
        cuts = [word] if len(word) <= 64 else [word[i:i + 64] for i in range(0, len(word), 32)]
        value = (-99,) * len(self.ordinary)
        for w in cuts:
            x = CARRIER + b" " + w + b" " + TAIL
            n = len(self.toxic(x))
            value = max(value, tuple(len(c(x)) - n for c in self.ordinary))
        self[word] = value
        return value

    def of(self, text: bytes) -> np.ndarray:
        """One row a window, one column an ordinary dictionary."""
        return np.array([self[w] for w in ascii_words(text)], np.int32).reshape(-1, len(self.ordinary))


#: Features of a document: for each ordinary dictionary counts at levels and the largest distance; the length.
FEATURES = len(ORDINARY) * (len(LEVELS) + 1) + 1


class Model:
    """Dictionaries, the usual log length, and the weights of a logistic score."""

    def __init__(self, toxic: bytes, ordinary: tuple[bytes, ...], usual: float = 0.0, weights: tuple = (0.0,) * (FEATURES + 1)):
        self.toxic, self.ordinary, self.usual, self.weights = toxic, ordinary, usual, weights

    def distance(self) -> Distance:
        return Distance(self.toxic, self.ordinary)

    def score(self, d: np.ndarray) -> float:
        a, *b = self.weights
        x = a + float(np.dot(b, _features(d, self.usual)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _features(d: np.ndarray, usual: float) -> list[float]:
    """Log counts of windows from each level on, the largest distance, log length; none for no window."""
    if not len(d):
        return [0.0] * FEATURES
    out = []
    for one in d.T:
        out += [*(math.log1p(int((one >= c).sum())) for c in LEVELS), float(min(14, max(0, one.max())))]
    return [*out, math.log1p(len(d)) - usual]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps on a ridge-penalised likelihood; few rows stay near the base rate."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pen = ridge * np.array([1e-3] + [1] * (x.shape[1] - 1))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pen), x.T @ (p - y) + pen * w)
    return w


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts a window is, by class and half (0: ordinary, 1 and 2: halves of the toxic texts)."""
    seen = tuple(Counter() for _ in range(3))

    def out():
        for y, c in enumerate(seen):
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(list(c), pa.binary()), "y": pa.array([y] * len(c), pa.int32()),
                "n": pa.array(list(c.values()), pa.int64())})
            c.clear()
    for run in runs(batches, "text"):
        for t, y, half in zip(*(run.column(c).to_pylist() for c in ("text", "y", "part"))):
            seen[y and 1 + half].update(set(ascii_words(t)))
            if sum(map(len, seen)) > HELD:
                yield from out()
    yield from out()


def train(counts: dict[str, list], texts: tuple[int, int]) -> Model | None:
    """Dictionaries from columns word, o, t0, t1 (ordinary texts and halves of the toxic texts that hold a
    window) and the numbers of ordinary and toxic texts; None if nothing is typical of toxic texts."""
    halves, ordinary = ({}, {}), {}
    for w, o, t0, t1 in zip(*(counts[c] for c in ("word", "o", "t0", "t1"))):
        if t0 + t1 and (t0 + t1) * texts[0] >= RATIO * o * texts[1]:
            for half, n in zip(halves, (t0, t1)):
                if n:
                    half[w] = n
        elif o:
            ordinary[w] = o
    usual = tuple(_dictionary(ordinary, size) for size in ORDINARY)
    toxic = _confirmed(halves, usual[0])
    return Model(_dictionary(toxic, TOXIC), usual) if toxic else None


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, key: str = "doc_id", text: str = "text",
        label: str = "toxic", rows: int = FIT_ROWS) -> Model | None:
    """Dictionaries and calibration from at most ``rows`` labelled training documents of each class.

    ``train_rows`` is a condition on ``key``. Of the fitted rows two thirds by key hash train the
    dictionaries and the rest calibrate. A key labelled more than once has its largest label; a key
    with several documents has them all. Without rows of both classes in both parts there is no model.
    The driver gets the distinct words of the fitted rows, counted.
    """
    order = F.md5(F.col(key).cast("string").cast("binary"))
    known = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & train_rows)
             .groupBy(key).agg(F.max(label).cast("int").alias("y")))
    pick = (known.where("y = 1").orderBy(order, key).limit(rows)
            .unionByName(known.where("y = 0").orderBy(order, key).limit(rows))
            .select(F.col(key).alias("__k"), "y", (F.conv(F.substring(order, 1, 8), 16, 10).cast("long") % 3).cast("int").alias("part")))
    # At most 2 * rows narrow rows travel, so that texts need not.
    sample = docs.join(F.broadcast(pick), F.col(key) == F.col("__k")).select(
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), "y", "part")
    n = {y: c for y, c in pick.where("part < 2").groupBy("y").count().collect()}
    if len(n) < 2:
        return None
    of = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))
    counts = (sample.where("part < 2").mapInArrow(_document_frequency, "word binary, y int, n long")
              .groupBy("word").agg(of(0).alias("o"), of(1).alias("t0"), of(2).alias("t1")).toArrow())
    model = train({c: counts.column(c).to_pylist() for c in counts.column_names}, (n[0], n[1]))
    if model is None:
        return None

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = model.distance()
        for part in runs(batches, "text"):
            got = [_features(far.of(t), 0.0) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"y": part.column("y"), "x": pa.array(got, pa.list_(pa.float64()))})

    seen = sample.where("part = 2").select("text", "y").mapInArrow(measure, "y int, x array<double>").collect()
    y, x = np.array([r.y for r in seen], float), np.array([r.x for r in seen], float)
    if not len(y) or y.min() == y.max():
        return None
    some = x[:, -1] > 0
    model.usual = float(x[some, -1].mean()) if some.any() else 0.0
    x[some, -1] -= model.usual
    model.weights = tuple(float(v) for v in _logistic(x, y))
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``score`` in 0..1, from every window of every text.

    Null, empty and blank texts have no window and take the score of no evidence; so do all texts
    if there is no model, for which that is 0. Words over 64 bytes are cut into overlapping windows.
    """
    def setup():
        far = model.distance() if model else None

        def run(texts):
            if not model:
                return (pa.array([0.0] * len(texts), pa.float64()),)
            return (pa.array([model.score(far.of((t or "").encode())) for t in texts], pa.float64()),)
        return run
    return annotate(docs, text, setup, [("score", "double")], keep)
