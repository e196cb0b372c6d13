"""Vector bin packing of token sequences.

A sequence has room for so many tokens, so many segments and so many loss-bearing tokens. While it is
open, the example that fits and whose demands have the largest dot product with what is left, each
resource as a share of its limit, goes in next. Where none fits, or the last segment is at hand, and
cutting is allowed, the longest example gives the tokens that are missing. Examples over a limit are
cut into full sequences first. A sequence that cannot be filled ends at a power of two, which needs no
padding, and its other tokens go back among the examples; without cutting it is padded.

Each task packs the examples it reads, in pools of bounded size, so nothing is shuffled: what a pool
leaves over joins the next, and only a task's last sequences can be short. A sequence number is the
partition's number and a running count, so a task that is run again gives the same.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import runs

#: The tokenizer that is used unless another path is given; the file has to be on every machine.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Tokens that a pool keeps for the next run of examples, so that every sequence has a choice.
KEEP = 256 * 1024
#: Bytes of text in one run of examples, and characters that are encoded at once.
RUN, PART = 2 << 20, 1 << 18
END = 1
_LOADED: dict[str, object] = {}


class Limits(NamedTuple):
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048


class Example:
    """Token ids of one row, and how many before each place bear loss (None: all)."""

    def __init__(self, ids: np.ndarray, before: np.ndarray | None, source: pa.RecordBatch, row: int):
        self.ids, self.before, self.source, self.row = ids, before, source, row

    def loss(self, start: int, stop: int) -> int:
        return stop - start if self.before is None else int(self.before[stop] - self.before[start])

    def reach(self, start: int, stop: int, tokens: int, loss: int) -> int:
        """The furthest place from ``start`` on within so many tokens and so many that bear loss."""
        if self.before is None:
            return min(stop, start + min(tokens, loss))
        far = int(np.searchsorted(self.before, self.before[start] + loss, side="right")) - 1
        return max(start, min(stop, start + tokens, far))


class Pool:
    """Pieces that wait, in classes of equal demands."""

    def __init__(self):
        self.number: dict[tuple[int, int], int] = {}
        self.size, self.loss, self.count = (np.zeros(64, np.int64) for _ in range(3))
        self.stacks: list[list] = []
        self.tokens = 0

    def add(self, example: Example, start: int, stop: int) -> None:
        key = stop - start, example.loss(start, stop)
        i = self.number.setdefault(key, len(self.stacks))
        if i == len(self.stacks):
            if i == len(self.size):
                self._grow()
                i = self.number.setdefault(key, len(self.stacks))
            self.stacks.append([])
            self.size[i], self.loss[i] = key
        self.stacks[i].append((example, start, stop))
        self.count[i] += 1
        self.tokens += key[0]

    def _grow(self) -> None:
        """Drops empty classes, and doubles the room if most are in use."""
        some = np.flatnonzero(self.count)
        room = len(self.size) * (2 if 2 * len(some) > len(self.size) else 1)
        size, loss, count = (np.zeros(room, np.int64) for _ in range(3))
        size[:len(some)], loss[:len(some)], count[:len(some)] = self.size[some], self.loss[some], self.count[some]
        self.size, self.loss, self.count = size, loss, count
        self.stacks = [self.stacks[i] for i in some.tolist()]
        self.number = {(int(a), int(b)): i for i, (a, b) in enumerate(zip(size[:len(some)], loss[:len(some)]))}

    def take(self, i: int) -> tuple[Example, int, int]:
        piece = self.stacks[i].pop()
        self.count[i] -= 1
        self.tokens -= int(self.size[i])
        return piece

    def best(self, left: Limits, limits: Limits) -> int | None:
        """The class that fits and has the largest dot product with what is left."""
        n = len(self.stacks)
        size, loss = self.size[:n], self.loss[:n]
        fits = (self.count[:n] > 0) & (size <= left.tokens) & (loss <= left.loss)
        # The segment's share is the same for all; the arg max needs the others only.
        value = np.where(fits, size * (left.tokens / limits.tokens ** 2) + loss * (left.loss / limits.loss ** 2), -1.0)
        i = int(value.argmax()) if n else 0
        return i if n and value[i] >= 0 else None

    def longest(self) -> int | None:
        n = len(self.stacks)
        value = np.where(self.count[:n] > 0, self.size[:n], 0)
        i = int(value.argmax()) if n else 0
        return i if n and value[i] else None


class Packer:
    """Takes examples and gives sequences, lists of (example, start, stop)."""

    def __init__(self, limits: Limits = Limits(), cut: bool = True):
        self.limits, self.cut, self.pool, self.full = limits, cut, Pool(), []

    def add(self, example: Example) -> None:
        """An example over a limit leaves full sequences at once; its rest waits."""
        at, n, lim = 0, len(example.ids), self.limits
        while at < n:
            to = example.reach(at, n, lim.tokens, lim.loss)
            if to == n:
                self.pool.add(example, at, n)
                return
            to = max(to, at + 1)
            if self.cut and to - at < lim.tokens:
                to = at + (1 << (to - at).bit_length() - 1)
            self.full.append([(example, at, to)])
            at = to

    def sequences(self, keep: int = 0) -> Iterator[list]:
        """Sequences, until the pool holds no more than ``keep`` tokens."""
        yield from self.full
        self.full = []
        while self.pool.tokens > keep:
            yield self._one()

    def _one(self) -> list:
        lim, pool, out, left = self.limits, self.pool, [], self.limits
        while left.tokens and left.segments:
            last = self.cut and left.segments == 1
            i = None if last and self._fills(left) else pool.best(left, lim)
            if i is not None:
                example, start, stop = pool.take(i)
            elif self.cut and out and (i := pool.longest()) is not None:
                example, start, end = pool.take(i)
                stop = example.reach(start, end, left.tokens, left.loss)
                if stop < end:
                    pool.add(example, stop, end)
                if stop == start:
                    break
            else:
                break
            out.append((example, start, stop))
            left = Limits(left.tokens - (stop - start), left.segments - 1, left.loss - example.loss(start, stop))
        size = lim.tokens - left.tokens
        if self.cut and left.tokens and size & (size - 1):
            return self._ended(out, 1 << size.bit_length() - 1)
        return out

    def _fills(self, left: Limits) -> bool:
        """Whether the longest example is more than what is left, so that the last segment can fill it."""
        i = self.pool.longest()
        return i is not None and int(self.pool.size[i]) > left.tokens

    def _ended(self, pieces: list, size: int) -> list:
        """The first ``size`` tokens; the others wait again."""
        out = []
        for example, start, stop in pieces:
            to = min(stop, start + size)
            size -= to - start
            if to > start:
                out.append((example, start, to))
            if to < stop:
                self.pool.add(example, to, stop)
        return out


def _tokenizer(path: str):
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def _encoder(path: str):
    """A faster encoder over the tokenizer's own vocabulary; its ids are the tokenizer's, tested so.

    Ids of a byte-level vocabulary are ranks of merges, which is all this encoder asks for. Bytes that
    have no letter of their own are spelled there by the letters from 256 on.
    """
    if ("fast", path) not in _LOADED:
        import tiktoken
        plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
        spelled = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        added = {t.content: i for i, t in _tokenizer(path).get_added_tokens_decoder().items()}
        ranks = {bytes(spelled[c] for c in t): i for t, i in _tokenizer(path).get_vocab(False).items() if t not in added}
        _LOADED["fast", path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _LOADED["fast", path]


def parts(text: str, size: int = PART) -> list[str]:
    """A long text in parts that the tokenizer cuts as it cuts the whole.

    The tokenizer's own pieces never hold a blank but as their first character, unless it stands among
    blanks; so a text can be cut before a single blank that follows something else. One without such a
    blank stays whole.
    """
    out, at = [], 0
    while len(text) - at > size:
        to = at + size
        while (to := text.find(" ", to)) > 0 and (text[to - 1].isspace() or text[to + 1:to + 2].isspace() or to + 1 == len(text)):
            to += 1
        if to < 0:
            break
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


def _ids(part: str, path: str) -> np.ndarray:
    try:
        return _encoder(path).encode_to_numpy(part, allowed_special="all")
    except ValueError:  # its pattern has no stack for a very long run of blanks
        return np.array(_tokenizer(path).encode(part, add_special_tokens=False).ids, np.uint32)


def encode(texts: list[str], path: str = TOKENIZER) -> list[np.ndarray]:
    """Token ids of each text and the end."""
    end = np.array([END], np.uint32)
    return [np.concatenate([*(_ids(p, path) for p in parts(text)), end]) for text in texts]


def loss_mask(formatted: str, spans: list[tuple[int, int]], path: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a formatted conversation with its end, and for each whether it begins inside a (start, length) span.

    The end bears loss if the last span ends with the text or its closing mark.
    """
    e = _tokenizer(path).encode(formatted, add_special_tokens=False)
    begin = np.array([o[0] for o in e.offsets] or [0], np.int64)[:len(e.ids)]
    mask = np.zeros(len(begin), bool)
    for start, length in spans:
        mask |= (begin >= start) & (begin < start + length)
    return np.append(np.array(e.ids, np.uint32), np.uint32(END)), np.append(mask, bool(spans))


_ADDED = [("start", "long"), ("length", "long"), ("ids", "binary"), ("loss_tokens", "long"), ("doc_tokens", "long"),
          ("sequence_id", "long"), ("offset", "long")]


class _Writer:
    """Rows of packed pieces: the source's columns ``kept`` and the added ones."""

    def __init__(self, kept: list[str], first: int):
        self.kept, self.number, self.held, self.bytes = kept, first, [], 0

    def add(self, sequence: list) -> None:
        at = 0
        for example, start, stop in sequence:
            self.held.append((example, start, stop, self.number, at))
            at += stop - start
        self.bytes += 4 * at
        self.number += 1

    def batches(self) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for x in self.held:
            by.setdefault(id(x[0].source), []).append(x)
        for pieces in by.values():
            rows = pa.array([e.row for e, *_ in pieces])
            got = [pieces[0][0].source.column(c).take(rows) for c in self.kept]
            added = zip(*[(a, b - a, e.ids[a:b].astype("<u4").tobytes(), e.loss(a, b), len(e.ids), n, o)
                          for e, a, b, n, o in pieces])
            kinds = [pa.binary() if t == "binary" else pa.int64() for _, t in _ADDED]
            yield pa.RecordBatch.from_arrays([*got, *(pa.array(list(c), k) for c, k in zip(added, kinds))],
                                             names=[*self.kept, *(n for n, _ in _ADDED)])
        self.held, self.bytes = [], 0


def _packed(examples, kept: list[str], limits: Limits, cut: bool):
    """A task: ``examples(batch)`` gives the examples of a batch, whose column ``__p`` is the partition."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, writer = Packer(limits, cut), None
        for batch in batches:
            for part in runs([batch], "__x", RUN):
                writer = writer or _Writer(kept, part.column("__p")[0].as_py() << 33)
                for e in examples(part):
                    packer.add(e)
                for s in packer.sequences(KEEP):
                    writer.add(s)
                    if writer.bytes > RUN:
                        yield from writer.batches()
        if writer:
            for s in packer.sequences():
                writer.add(s)
                if writer.bytes > RUN:
                    yield from writer.batches()
            yield from writer.batches()
    return work


def _run(df: DataFrame, value: Column, examples, keep: list[str] | None, limits: Limits, cut: bool, *more: Column) -> DataFrame:
    names = {n for n, _ in _ADDED}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    shown = df.select(*[F.col(f"`{c}`") for c in kept], value.alias("__x"), F.spark_partition_id().alias("__p"), *more)
    schema = ", ".join([f"`{c}` {shown.schema[c].dataType.simpleString()}" for c in kept] + [f"{n} {t}" for n, t in _ADDED])
    return shown.mapInArrow(_packed(examples, kept, limits, cut), schema)


def pack_texts(df: DataFrame, text: str = "text", path: str = TOKENIZER, limits: Limits = Limits(), cut: bool = True,
               keep: list[str] | None = None) -> DataFrame:
    """One row per packed piece of each text: the columns ``keep`` (default: all) and ``start``, ``length``,
    ``ids`` (little-endian, four bytes each), ``loss_tokens``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A text's ids are the tokenizer's and one end; all bear loss. Null and empty texts have the end
    alone. Repeated rows are texts of their own. Columns named like an added one are replaced. A very
    long text is tokenized in parts and cut into full sequences. An empty table gives no rows.
    """
    def examples(part: pa.RecordBatch):
        for i, ids in enumerate(encode([t.decode() for t in part.column("__x").to_pylist()], path)):
            yield Example(ids, None, part, i)
    return _run(df, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), examples, keep, limits, cut)


def pack_conversations(df: DataFrame, formatted: str = "formatted", loss: str = "loss", path: str = TOKENIZER,
                       limits: Limits = Limits(loss=1024), cut: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Instruction data as ``format_conversations`` gives it, packed; rows and columns as in ``pack_texts``.

    Ids that begin inside a span of ``loss`` bear loss, and so does the end after a spoken answer.
    Conversations stay whole, but one that is over a limit by itself is cut; the others' sequences are
    padded. A null text or null spans are empty.
    """
    def examples(part: pa.RecordBatch):
        for i, (t, spans) in enumerate(zip(part.column("__x").to_pylist(), part.column("__loss").to_pylist())):
            ids, mask = loss_mask(t.decode(), [(s["start"], s["length"]) for s in spans or []], path)
            yield Example(ids, np.append(0, np.cumsum(mask)), part, i)
    return _run(df, F.coalesce(F.col(formatted), F.lit("")).cast("binary"), examples, keep, limits, cut, F.col(loss).alias("__loss"))
