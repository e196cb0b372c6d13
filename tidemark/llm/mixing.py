"""Mixing overlapping sources to target weights by min-cost flow over membership patterns.

A document may belong to several sources; documents with the same set of sources form a pattern.
Words flow from patterns to the sources they belong to, up to each source's target; a pattern's
words cost nothing at the first use and more at every further one, so repetition starts only where
first uses run out. The flow fixes how many words of a pattern each use takes and for which source;
documents then fill these amounts in a seeded order, whole but for one at each end.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD

#: Bins of the seeded order within a pattern (hex digits of the draw).
DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...], share: float, most: float,
            total: int | None = None) -> dict[str | None, float]:
    """Words wanted of each source. Sources by code point, null last, take ``weights`` in turn and
    share ``share`` of all words; none wants over ``most`` times its own size, and what is over goes
    to the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, got = share * (sum(sizes.values()) if total is None else total), {}
    open_ = list(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not over:
            return got | {s: unit * weight[s] for s in open_}
        for s in over:
            got[s] = most * sizes[s]
            left -= got[s]
        open_ = [s for s in open_ if s not in over]
    return got


class _Flow:
    """Min-cost flow on a small graph: cheapest augmenting paths, found with a queue."""

    def __init__(self):
        self.arcs: list[list] = []
        self.out: dict[object, list[int]] = {}

    def arc(self, a, b, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out.setdefault(x, []).append(len(self.arcs))
            self.arcs.append([y, r, c])
        return len(self.arcs) - 2

    def run(self, start, end) -> None:
        while True:
            dist, by, queue, queued = {start: 0}, {}, deque([start]), {start}
            while queue:
                x = queue.popleft()
                queued.discard(x)
                for i in self.out.get(x, ()):
                    y, room, cost = self.arcs[i]
                    if room and dist[x] + cost < dist.get(y, float("inf")):
                        dist[y], by[y] = dist[x] + cost, i
                        if y not in queued:
                            queue.append(y)
                            queued.add(y)
            if end not in dist:
                return
            path, x = [], end
            while x != start:
                path.append(by[x])
                x = self.arcs[by[x] ^ 1][0]
            room = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= room
                self.arcs[i ^ 1][1] += room

    def used(self, i: int) -> int:
        return self.arcs[i ^ 1][1]


def route(words: dict[tuple, int], want: dict[str | None, float], uses: int) -> dict[tuple, tuple[list[int], dict]]:
    """For each pattern, the words each use takes and the words each of its sources gets."""
    g = _Flow()
    use = {p: [g.arc("start", ("p", p), n, r * r) for r in range(uses)] for p, n in words.items()}
    give = {(p, s): g.arc(("p", p), ("s", s), uses * n, 0) for p, n in words.items() for s in p}
    for s, t in want.items():
        g.arc(("s", s), "end", int(t + 0.5), 0)
    g.run("start", "end")
    return {p: ([g.used(i) for i in use[p]], {s: g.used(give[p, s]) for s in p}) for p in words}


def _key(sources: Column) -> Column:
    """A set of sources as one text; null sorts last."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(
        sources, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("~"))))), "\0")


def _names(key: str) -> tuple:
    return tuple(None if s == "~" else s[1:] for s in key.split("\0"))


def mix(df: DataFrame, sources: Column, size: Column, key: str = "doc_id", weights: tuple[int, ...] = (3, 1, 2),
        share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """All rows of ``df`` with ``size``, ``taken`` words and ``given``, the words by source, added (columns of
    those names are replaced).

    ``taken`` is a whole number of uses but for one document at the end of each use of a pattern;
    ``whole_uses`` rounds it. Null ``sources`` or a null in it is a source of its own; repeated rows are documents of their own, ordered by all that is known of them;
    an empty table gives an empty result. ``targets_of`` of the same frame gives the targets. The
    driver holds one row for each pattern.
    """
    names = {c: f"__kept{i}" for i, c in enumerate(df.columns) if c.lower() not in ("size", "taken", "given")}
    kept = [F.col(n).alias(c) for c, n in names.items()]
    # Rows without an id are told apart by all they hold, so that no bin gets all of them.
    known = F.coalesce(F.col(key).cast("string"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    draw = F.md5(F.concat(F.lit(seed + "|"), known).cast("binary"))
    base = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], size.alias("size"), draw.alias("draw"),
                     _key(F.coalesce(sources, F.array(F.lit(None).cast("string")))).alias("pattern"))
    base = base.withColumn("bin", F.substring("draw", 1, DIGITS))
    words, want = plan_inputs(base, weights, share, most)
    flows = []
    for p, (uses, gives) in route(words, want, most).items():
        at, spans = 0, []
        for s, n in gives.items():
            spans.append((s, at, at + n))
            at += n
        flows.append(("\0".join("~" if s is None else "=" + s for s in p), uses, spans))
    spark = df.sparkSession
    flow = spark.createDataFrame(
        flows, "pattern string, uses array<long>, spans array<struct<source:string,low:long,high:long>>")
    bins = base.groupBy("pattern", "bin").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("pattern").orderBy("bin")) - F.col("words")
    starts = bins.select("pattern", "bin", before.alias("start"))
    in_bin = Window.partitionBy("pattern", "bin").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (base.join(starts, ["pattern", "bin"])
              .withColumn("at", F.col("start") + F.sum("size").over(in_bin) - F.col("size")).join(flow, "pattern"))
    # On a pattern's line of words the uses follow one another; this document's stretch of each use:
    stretch = F.expr("""transform(uses, (u, r) -> named_struct(
        'low', aggregate(slice(uses, 1, r), 0L, (a, x) -> a + x) + least(at, u),
        'high', aggregate(slice(uses, 1, r), 0L, (a, x) -> a + x) + least(at + size, u)))""")
    given = F.expr("""filter(transform(spans, s -> named_struct('source', s.source, 'words',
        aggregate(stretch, 0L, (a, x) -> a + greatest(0L, least(x.high, s.high) - greatest(x.low, s.low))))),
        g -> g.words > 0)""")
    return (placed.withColumn("stretch", stretch)
            .select(*kept, "size", F.expr("aggregate(stretch, 0L, (a, x) -> a + x.high - x.low)").alias("taken"),
                    given.alias("given")))


def plan_inputs(base: DataFrame, weights: tuple[int, ...], share: float, most: int):
    """Words by pattern, and targets by source, of a frame with ``pattern`` and ``size``."""
    words = {_names(r.pattern): r.words
             for r in sorted(base.groupBy("pattern").agg(F.sum("size").alias("words")).collect())}
    sizes: dict[str | None, int] = {}
    for p, n in words.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    return words, targets(sizes, weights, share, most, sum(words.values()))


def whole_uses() -> Column:
    """How often a document of the mix is used as a whole.

    A last partial use counts as a whole one from half the document's words on, and else as none, so
    the words of a source differ from its target by at most half a document for each end of a use.
    The number of uses never exceeds that of ``mix``'s ``most``.
    """
    return F.expr("if(size > 0, cast((2 * taken + size) div (2 * size) as int), 0)")


def take_whole(mixed: DataFrame) -> DataFrame:
    """The mix itself, of whole documents: every row as often as it is used. No text is cut."""
    kept = [c for c in mixed.columns if c not in ("size", "taken", "given")]
    return mixed.select(*[F.col(f"`{c}`") for c in kept],
                        F.explode(F.array_repeat(F.lit(0), whole_uses())).alias("__use")).drop("__use")
