"""Small helpers shared by the training-data operators: words, keyed folds, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of anything but ASCII blanks. ``bytes.split()`` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are worked on in runs of about this many bytes, so memory follows neither rows nor partitions.
RUN_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, of: int) -> Column:
    """crc32 of the key's text modulo ``of``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % of


def raw(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def runs(batches: Iterator[pa.RecordBatch], column: str, size: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that ``column`` (string or binary) holds about ``size`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def ascii_words(text: bytes) -> list[bytes]:
    """Words of a text with A-Z lower-cased."""
    return text.lower().split()


def veiled(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns under private names, and these names, so that none clashes with an operator's own."""
    names = {c: f"__doc{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def unveiled(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``veiled`` under their own names again, without others."""
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


class WordHash(dict):
    """64-bit hash of a word, remembered for frequent words; forgets everything at ``most`` entries."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64 (xor-shift-multiply), so that sums and products of hashes spread again."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-word shingle, in order; fewer words are one shingle, none is none."""
    n = len(words)
    if n == 0:
        return words
    step = np.uint64(0x9FB21C651E98DF25)
    out = np.zeros(max(n - k + 1, 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(k, n)):
            out = (out + words[i:i + len(out)]) * step
            out ^= out >> np.uint64(33)
        return mix64(out)


def annotate(df: DataFrame, text: str, setup, added: list[tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns computed in Python from whole texts.

    ``setup()`` runs once a task and gives a function from a list of texts (None for null) to one
    list or array per added (name, type). Added names replace columns that clash with them.
    """
    taken = {n.lower() for n, _ in added}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    own = text if text in kept and dict(df.dtypes)[text] == "string" else "__text"
    cols = [F.col(f"`{c}`") for c in kept] + ([] if own == text else [F.col(f"`{text}`").cast("string").alias(own)])
    shown = df.select(*cols)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in shown.schema if f.name in kept]
                       + [f"`{n}` {t}" for n, t in added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = setup()
        for part in runs(batches, own):
            got = run(part.column(own).to_pylist())
            arrays = [part.column(c) for c in kept] + [pa.array(g) if isinstance(g, list) else g for g in got]
            yield pa.RecordBatch.from_arrays(arrays, names=kept + [n for n, _ in added])
    return shown.mapInArrow(work, schema)
