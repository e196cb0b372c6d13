"""Document likelihood under a subword lattice.

The pieces of an existing tokenizer are the vocabulary. Their probabilities are relative counts over
all training words, as the tokenizer cuts them; each distinct word counts once, since spelling is for words seldom seen. A word's probability is the sum over
every way to cut it into pieces, found by a forward recursion in logarithms; a document is its words
and one end. The lattice of a word also has one arc over the whole word, weighted by its training count
(Witten-Bell), so what was seen often is not spelled anew. Words are counted and scored once each, however often they occur: documents are read in
runs, each run sends every distinct word once with its places, and gets its score and count back.
"""

from __future__ import annotations

import itertools
import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import ascii_words, raw, runs

#: Folder of the public tokenizer files, and the one used; both are parameters of ``score``.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
PIECES = "piece_bpe_32k.model"
#: Bytes of text in one run of documents.
RUN = 12 << 20
#: Bytes of a word's places that one task joins; a word with more is dealt out by its runs.
PLACES = 4 << 20
#: Documents in one run; a place is two numbers of 16 bits, document and count.
RUN_ROWS = 1 << 16
SMOOTH = 0.1
START = "▁"
_LOADED: dict[str, object] = {}


def _processor(path: str):
    if path not in _LOADED:
        import sentencepiece
        _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def _pieces(path: str) -> list[str]:
    sp = _processor(path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())]


class Lattice:
    """Log10 probability of words, summed over all cuts into pieces of known probability.

    A character that no piece holds is spelled by its UTF-8 bytes. The end of a document is an
    event of its own, so that all piece sequences have total probability one.
    """

    def __init__(self, pieces: list[str], counts: np.ndarray, ends: int):
        total = counts.sum() + SMOOTH * (len(pieces) + 1) + ends
        logs = np.log((counts + SMOOTH) / total)
        self.bytes = {int(p[3:5], 16): float(x) for p, x in zip(pieces, logs) if len(p) == 6 and p.startswith("<0x")}
        self.log = {p: float(x) for p, x in zip(pieces, logs) if not (p.startswith("<") and p.endswith(">") and len(p) > 2)}
        self.longest = max(map(len, self.log), default=1)
        self.rare = float(np.log(SMOOTH / total))
        # At a word's edge the next event is a word start or the end.
        start = sum(math.exp(x) for p, x in self.log.items() if p.startswith(START))
        self.end = math.log10((ends + SMOOTH) / total / (start + (ends + SMOOTH) / total))

    def word(self, token: bytes) -> float:
        s = START + token.decode("utf-8", "replace")
        n, log, get, exp = len(s), math.log, self.log.get, math.exp
        ahead: list[list[float]] = [[] for _ in range(n + 1)]
        at = 0.0
        for i in range(n):
            if i:
                paths = ahead[i]
                if not paths:
                    continue
                best = max(paths)
                at = best if len(paths) == 1 else best + log(sum([exp(x - best) for x in paths]))
                ahead[i] = paths = []
            for j in range(i + 1, min(n, i + self.longest) + 1):
                p = get(s[i:j])
                if p is not None:
                    ahead[j].append(at + p)
            if s[i] not in self.log:
                ahead[i + 1].append(at + sum(self.bytes.get(b, self.rare) for b in s[i].encode()))
        best = max(ahead[n])
        return (best + log(sum([exp(x - best) for x in ahead[n]]))) / log(10)


_ROW = "run long, token binary, trained long, places binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct word of a run: training count and (document, count) pairs; and one
    row without a word that holds the run's documents."""
    for part in (b.slice(i, RUN_ROWS) for b in runs(batches, "text", RUN) for i in range(0, b.num_rows, RUN_ROWS)):
        vocabulary: dict[bytes, int] = {}
        number = itertools.count()
        ids, ends = [], []
        fresh = vocabulary.setdefault
        for t in part.column("text").to_pylist():
            words = ascii_words(t)
            got = np.fromiter((vocabulary.get(w, -1) for w in words), np.int64, len(words))
            for k in np.flatnonzero(got < 0).tolist():
                w = words[k]
                got[k] = fresh(w, -1) if w in vocabulary else fresh(w, next(number))
            ids.append(got)
            ends.append(len(words))
        docs = np.repeat(np.arange(len(ends)), ends)
        key, n = np.unique(np.concatenate(ids) * len(ends) + docs, return_counts=True)
        word, doc = key // len(ends), key % len(ends)
        train = np.array(part.column("train").to_pylist(), bool)
        trained = np.bincount(word, n * train[doc], len(vocabulary)).astype(np.int64)
        many = -(-n // 0xFFFF)  # a count that does not fit is given in parts
        if many.max(initial=1) > 1:
            last = n - (many - 1) * 0xFFFF
            word, doc, n = (np.repeat(x, many) for x in (word, doc, np.full(len(n), 0xFFFF)))
            n[np.cumsum(many) - 1] = last
        pairs = np.column_stack([doc, n]).astype(np.uint16)
        cuts = np.searchsorted(word, np.arange(len(vocabulary) + 1))
        packed = pairs.tobytes()
        run = int(part.column("run")[0].as_py())
        yield pa.RecordBatch.from_pydict({
            "run": pa.array([run], pa.int64()), "token": pa.array([None], pa.binary()),
            "trained": pa.array([int(train.sum())], pa.int64()),
            "places": pa.array([_documents(part, ends)], pa.binary())})
        tokens = list(vocabulary)
        for a in range(0, len(tokens), 50_000):
            b = min(len(tokens), a + 50_000)
            yield pa.RecordBatch.from_pydict({
                "run": pa.array(np.full(b - a, run)), "token": pa.array(tokens[a:b], pa.binary()),
                "trained": pa.array(trained[a:b]),
                "places": pa.array([packed[4 * x:4 * y] for x, y in zip(cuts[a:b], cuts[a + 1:b + 1])], pa.binary())})


def _documents(part: pa.RecordBatch, words: list[int]) -> bytes:
    t = pa.table({"key": part.column("key"), "train": part.column("train"), "n": pa.array(words, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def whole_word(lattice: np.ndarray | float, count: np.ndarray | int, total: int, distinct: int):
    """Log10 probability with the whole-word arc: seen share plus the unseen share of the lattice, added in logarithms."""
    if not total:
        return lattice
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(count), np.log(distinct) + lattice * math.log(10)) / math.log(10) - math.log10(total + distinct)


def _finish(total: int, distinct: int, ends: int, end_score: float):
    base = math.log10(total + distinct + 1)

    def one(t: pa.Table) -> pa.Table:
        head = t.filter(t.column("head"))
        docs = pa.ipc.open_stream(head.column("places")[0].as_py()).read_all()
        words = t.filter(pa.compute.invert(t.column("head")))
        size = docs.num_rows
        c = words.column("count").to_numpy()
        own = np.frombuffer(b"".join(words.column("places").to_pylist()), np.uint16).reshape(-1, 2).astype(np.int64)
        per = np.array([len(x) // 4 for x in words.column("places").to_pylist()], np.int64)
        doc, n = own[:, 0], own[:, 1]
        sum_ = lambda x: np.bincount(doc, np.repeat(x, per) * n, size)
        end = math.log10(ends + 1) - base
        lattice = words.column("score").to_numpy()
        full = whole_word(lattice, c, total, distinct)
        tokens = docs.column("n").to_numpy() + 1
        return pa.table({
            "key": docs.column("key"), "train": docs.column("train"), "n_tokens": pa.array(tokens),
            "n_known": pa.array((sum_(c > 0) + (ends > 0)).astype(np.int64)),
            "train_tokens": pa.array(np.full(size, total)),
            "base_score": pa.array(sum_(np.log10(c + 1) - base) + end),
            "score": pa.array(sum_(full) + whole_word(end_score, ends, total, distinct)),
            "lattice_score": pa.array(sum_(lattice) + end_score)})
    return one


def score(df: DataFrame, train: Column, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS,
          pieces: str = PIECES) -> DataFrame:
    """One row per document: key (long), ``train``, n_tokens, n_known, train_tokens, base_score, score,
    and lattice_score, the likelihood without whole-word arcs.

    Words are runs of anything but ASCII blanks with A-Z lower-cased; the end counts as one more
    token; very long words are words too, of which only the pieces are looked up. A null or empty text is its end alone. A null key stays null; repeated rows are scored
    each. Without training rows every count is zero and pieces are equally likely. An empty table
    gives no rows. Only the piece counts, as many as the vocabulary has pieces, reach the driver. Every
    machine has the tokenizer's ``folder``.
    """
    path = os.path.join(folder, pieces)
    docs = df.select(F.monotonically_increasing_id().alias("run"), F.col(key).cast("long").alias("key"),
                     F.coalesce(train, F.lit(False)).alias("train"), raw(F.col(text)).alias("text"))
    read = materialize(docs.mapInArrow(_read, _ROW), "lattice-words")
    ends = read.where("token is null").agg(F.coalesce(F.sum("trained"), F.lit(0))).first()[0]
    counts = materialize(read.where("token is not null").groupBy("token").agg(
        F.sum("trained").alias("count"), (F.sum(F.octet_length("places")) / PLACES + 1).cast("int").alias("parts")), "lattice-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 0)).first()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(path)
        seen = np.zeros(sp.get_piece_size(), np.int64)
        for part in runs(batches, "token"):
            words = [t.decode("utf-8", "replace") for t in part.column("token").to_pylist()]
            got = sp.encode(words, num_threads=1)
            np.add.at(seen, np.fromiter(itertools.chain.from_iterable(got), np.int64), 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(at), "n": pa.array(seen[at])})

    found = (counts.where("count > 0").mapInArrow(cut, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
             .collect())
    names = _pieces(path)
    seen = np.zeros(len(names), np.int64)
    for r in found:
        seen[r.piece] = r.n
    lattice = Lattice(names, seen, int(ends))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, "token", 1 << 20):
            yield pa.RecordBatch.from_pydict({
                "token": part.column("token"), "parts": part.column("parts"), "count": part.column("count"),
                "score": pa.array([lattice.word(t) for t in part.column("token").to_pylist()], pa.float64())})

    # A word in most runs is in one part for every few MB of places. Such words are few and known before the join.
    often = materialize(counts.where("parts > 1").select("token", "parts"), "lattice-often")
    weighed = (counts.mapInArrow(weigh, "token binary, parts int, count long, score double")
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    dealt = F.pmod(F.xxhash64("run"), F.coalesce("parts", F.lit(1))).cast("int")
    back = (read.where("token is not null").join(often, "token", "left").withColumn("part", dealt).drop("parts")
            .join(weighed, ["token", "part"])
            .select("run", F.lit(False).alias("head"), "places", "count", "score")
            .unionByName(read.where("token is null").select(
                "run", F.lit(True).alias("head"), "places", F.lit(0).cast("long").alias("count"), F.lit(0.0).alias("score"))))
    known = int(distinct) + (ends > 0)
    return back.groupBy("run").applyInArrow(
        _finish(int(total) + int(ends), known, int(ends), lattice.end),
        "key long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
        "lattice_score double")
