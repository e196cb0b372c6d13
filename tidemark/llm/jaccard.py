"""Exact Jaccard links between documents' word-shingle sets, and their components.

A set's shingles are hashed into groups; the counts per group are its point. The sum of coordinate
minima of two points bounds the overlap of their sets, and an R-tree over points (each inner node
keeps the largest coordinates and the smallest size below it) skips whole subtrees that cannot reach
the overlap asked for. Pairs that survive are verified on the sets themselves.

Points meet through their rarest shingles: two sets of similarity T share one of the first
(1 - T) n + 1 shingles in any common order. The order used is by rarity in a sketch of bounded size,
so a passage that many documents share brings together only documents that consist of it. Equal
sets are one node. A first round ties each node to one node of its blocks, so that large groups of
near copies collapse without forming their pairs; the second looks, with the R-tree, only between
components that are not connected yet, until one link or none is found for each node and part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import WordHash, ascii_words, raw, runs, shingle_hashes

#: Words in a shingle; two sets link if OVER * intersection >= UNDER * (sum of sizes), similarity 3/4.
K, OVER, UNDER = 5, 7, 3
#: Sketch of shingle frequencies: 2**BITS counters, moved in parts.
BITS, PARTS = 20, 64
#: Nodes of one shingle that are looked at together; more are split.
HOT = 4096
#: Children of an R-tree node; members of a verification group; nodes in a cell of a block.
FAN, GROUP, CELL = 16, 256, 2000


def shingle_set(text: bytes, hashes: WordHash) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    return np.unique(shingle_hashes(hashes.of(ascii_words(text)), K))


def dims(n: int) -> int:
    """Groups for a set of n: the power of two from n / 2 on."""
    return 1 << max(2, ((int(n) + 1) // 2 - 1).bit_length())


def point(s: np.ndarray) -> np.ndarray:
    """Shingles in each group. Groups of a smaller count of groups are sums of these."""
    g = dims(len(s))
    return np.bincount((s & np.uint64(g - 1)).astype(np.int64), minlength=g)


def _pack(p: np.ndarray) -> bytes:
    return p.astype(np.uint8 if p.max(initial=0) < 256 else np.uint16).tobytes()


def _unpack(b: bytes, n: int) -> np.ndarray:
    return np.frombuffer(b, np.uint8 if len(b) == dims(n) else np.uint16).astype(np.int32)


def folded(p: np.ndarray, g: int) -> np.ndarray:
    return p if len(p) == g else p.reshape(-1, g).sum(axis=0)


class RTree:
    """Bulk-loaded over points of one length: sorted by size and then by coordinates, packed FAN to a node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((*points.T[:4], sizes))
        self.order = order
        self.levels = [(points[order], sizes[order])]
        while len(self.levels[-1][1]) > FAN:
            high, low = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.maximum.reduceat(high, at, axis=0), np.minimum.reduceat(low, at)))

    def near(self, point: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all points whose overlap bound reaches what a link needs, and the bounds."""
        at = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low = self.levels[depth]
            bound = np.minimum(high[at], point).sum(axis=1)
            keep = OVER * bound >= UNDER * (size + low[at])
            at, bound = at[keep], bound[keep]
            if depth:
                below = len(self.levels[depth - 1][1])
                at = (at[:, None] * FAN + np.arange(FAN)).ravel()
                at = at[at < below]
        return self.order[at], bound


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if OVER * len(small) < UNDER * (len(a) + len(b)):
        return False
    where = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return OVER * int((large[where] == small).sum()) >= UNDER * (len(a) + len(b))


def _roots(n: int):
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        up[max(a, b)] = min(a, b)
    return find, join


def link_sets(sets: list[np.ndarray], hub: int) -> list[int]:
    """For each set the smallest place it is connected with by links among these sets."""
    find, join = _roots(len(sets))
    for i, s in enumerate(sets):
        if i != hub and linked(sets[hub], s):
            join(i, hub)
    root = np.array([find(i) for i in range(len(sets))])
    if len(np.unique(root)) > 1:
        g = min(dims(len(s)) for s in sets)
        points = np.array([folded(point(s), g) for s in sets])
        tree = RTree(points, np.array([len(s) for s in sets]))
        most = np.bincount(root).argmax()
        # Every pair between components has an end outside the largest.
        for i in np.flatnonzero(root != most).tolist():
            for j in tree.near(points[i], len(sets[i]))[0].tolist():
                if find(i) != find(j) and linked(sets[i], sets[j]):
                    join(i, j)
    return [find(i) for i in range(len(sets))]


# --- tasks -----------------------------------------------------------------------------------


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: set size, signature and point; and at the end the task's part of the sketch."""
    hashes, sketch = WordHash(), np.zeros(1 << BITS, np.uint32)
    names = ["part", "doc_id", "place", "n", "sig", "point"]
    for part in runs(batches, "text"):
        sets = [shingle_set(t, hashes) for t in part.column("text").to_pylist()]
        sketch += np.bincount((np.concatenate(sets) >> np.uint64(64 - BITS)).astype(np.int64),
                              minlength=1 << BITS).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(sets), pa.int32()), part.column("doc_id"), part.column("place"),
            pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s) for s in sets], pa.int64()),
            pa.array([_pack(point(s)) for s in sets], pa.binary())], names)
    none = pa.nulls(PARTS, pa.int64())
    yield pa.RecordBatch.from_arrays([
        pa.array(np.arange(PARTS, dtype=np.int32)), none, none, none, none,
        pa.array([p.tobytes() for p in np.split(sketch, PARTS)], pa.binary())], names)


def signature(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _add_sketches(t: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.uint32).astype(np.uint64) for b in t.column("point").to_pylist())
    return pa.table({"part": t.column("part")[:1], "counts": pa.array([np.minimum(total, 2 ** 32 - 1).astype(
        np.uint32).tobytes()], pa.binary())})


def _rarest(sketch: np.ndarray):
    """(shingle, salt, signature) of each set's rarest quarter; shingles of many documents are salted."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHash(), set()
        for part in runs(batches, "text"):
            keys, salts, sigs = [], [], []
            for t in part.column("text").to_pylist():
                s = shingle_set(t, hashes)
                sig = signature(s)
                if not len(s) or sig in seen:
                    continue
                seen.add(sig)
                often = sketch[(s >> np.uint64(64 - BITS)).astype(np.int64)]
                first = np.argsort(often, kind="stable")[:len(s) // 4 + 1]
                often = often[first].astype(np.int64)
                keys.append(s[first])
                salts.append(np.where(often > HOT, 1 + (sig & 0x7FFFFFFF) % (-(-often // HOT)), 0).astype(np.int32))
                sigs.append(np.full(len(first), sig))
            if len(seen) > 1_000_000:
                seen.clear()
            if keys:
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(np.concatenate(keys).view(np.int64)), "salt": pa.array(np.concatenate(salts)),
                    "sig": pa.array(np.concatenate(sigs))})
    return task


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose points allow a link, with the bound."""
    for part in batches:
        keep, bounds = [], []
        for na, pa_, nb, pb in zip(*[part.column(c).to_pylist() for c in ("n", "point", "hub_n", "hub_point")]):
            a, b = _unpack(pa_, na), _unpack(pb, nb)
            g = min(len(a), len(b))
            bound = int(np.minimum(folded(a, g), folded(b, g)).sum())
            keep.append(OVER * bound >= UNDER * (na + nb))
            bounds.append(bound)
        yield pa.RecordBatch.from_arrays([part.column("sig"), part.column("hub"), pa.array(bounds, pa.int64())],
                                         ["sig", "hub", "bound"]).filter(pa.array(keep, pa.bool_()))


def _verify(t: pa.Table) -> pa.Table:
    """Edges of a spanning forest of a group: one hub and its partners."""
    rows = {r["sig"]: r for r in t.to_pylist()}
    sigs = sorted(rows)
    hashes = WordHash()
    sets = [shingle_set(rows[s]["text"], hashes) for s in sigs]
    root = link_sets(sets, sigs.index(t.column("hub")[0].as_py()))
    pairs = [(s, sigs[r]) for s, r in zip(sigs, root) if s != sigs[r]]
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _between(t: pa.Table) -> pa.Table:
    """Nodes of a cell with the parts of other components that hold a point near theirs."""
    cols = {c: t.column(c).to_numpy() for c in ("key", "low", "high", "sig", "root", "chunk", "n")}
    packed = t.column("point").to_pylist()
    order = np.lexsort((cols["sig"], cols["high"], cols["low"], cols["key"]))
    cell = np.column_stack([cols[c][order] for c in ("key", "low", "high")])
    cuts = np.flatnonzero(np.any(cell[1:] != cell[:-1], axis=1)) + 1 if len(cell) else []
    found: set[tuple[int, int, int]] = set()
    for rows in np.split(order, cuts):
        sig, root, chunk, n = (cols[c][rows] for c in ("sig", "root", "chunk", "n"))
        if len(rows) < 2 or (root == root[0]).all():
            continue
        points = [_unpack(packed[r], cols["n"][r]) for r in rows.tolist()]
        g = min(map(len, points))
        tree = RTree(np.array([folded(p, g) for p in points]), n)
        _, inverse, count = np.unique(root, return_inverse=True, return_counts=True)
        # Every pair between components has an end outside the largest.
        for i in np.flatnonzero(inverse != count.argmax()).tolist():
            near, _ = tree.near(folded(points[i], g), int(n[i]))
            for j in near[root[near] != root[i]].tolist():
                part = (int(sig[i]), int(root[j]), int(chunk[j]))
                if part not in found:
                    h = min(len(points[i]), len(points[j]))
                    bound = int(np.minimum(folded(points[i], h), folded(points[j], h)).sum())
                    if OVER * bound >= UNDER * int(n[i] + n[j]):
                        found.add(part)
    return pa.table({c: pa.array([p[k] for p in found], pa.int64()) for k, c in enumerate(("sig", "root", "chunk"))})


def _search(t: pa.Table) -> pa.Table:
    """A link, if there is one, from each asking node to the part of a component it is held against."""
    hashes = WordHash()
    sets = {s: shingle_set(x, hashes) for s, x in zip(t.column("sig").to_pylist(), t.column("text").to_pylist())}
    asks = sorted({s for s, a in zip(t.column("sig").to_pylist(), t.column("asks").to_pylist()) if a})
    part = sorted({s for s, a in zip(t.column("sig").to_pylist(), t.column("asks").to_pylist()) if not a})
    found = []
    if part:
        g = min(dims(len(s)) for s in sets.values())
        tree = RTree(np.array([folded(point(sets[x]), g) for x in part]), np.array([len(sets[x]) for x in part]))
        for y in asks:
            near, bound = tree.near(folded(point(sets[y]), g), len(sets[y]))
            for j in near[np.argsort(-bound, kind="stable")].tolist():
                if linked(sets[y], sets[part[j]]):
                    found.append((y, part[j]))
                    break
    return pa.table({"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())})


# --- joins -----------------------------------------------------------------------------------


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(sig, root) of every node with an edge, root the smallest node of its component.

    Edges are turned to stars in alternation until nothing changes: every larger neighbour goes to a
    node's smallest, then every smaller one does. Written between rounds.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                    label)

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both if large else both.where("b < a")
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        moved = near.where("b > a") if large else near
        ends = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            ends = ends.union(least.select("a", F.col("m").alias("b")))
        return ends.where("a <> b").distinct()

    mark = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    was = mark(e)
    while was[0]:
        e = materialize(star(star(e, True), False), label)
        now = mark(e)
        if now == was:
            break
        was = now
    return e.select(F.col("a").alias("sig"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("sig"), F.col("b").alias("root")).distinct())


class _Join:
    """One run of the join over documents (doc_id, place, text)."""

    def __init__(self, docs: DataFrame):
        self.docs = docs
        rows = materialize(docs.mapInArrow(_nodes, "part int, doc_id long, place long, n long, sig long, point binary"),
                           "jaccard-nodes")
        self.members = rows.where("part is null").select("doc_id", "place", "n", "sig")
        # Equal sets are one node; the row that gives its text is the one with the smallest id.
        self.nodes = (rows.where("part is null and n > 0").groupBy("sig")
                      .agg(F.min_by(F.struct("doc_id", "place"), F.struct(_known("doc_id"), "place")).alias("at"),
                           F.first("n").alias("n"),
                           F.first("point").alias("point")))
        parts = (rows.where("part is not null").groupBy("part").applyInArrow(_add_sketches, "part int, counts binary")
                 .collect())
        sketch = np.concatenate([np.frombuffer(r.counts, np.uint32) for r in sorted(parts)]) if parts else np.zeros(
            1 << BITS, np.uint32)
        self.blocks = materialize(self._blocks(sketch), "jaccard-blocks")

    def _blocks(self, sketch: np.ndarray) -> DataFrame:
        """(key, salt, sig, hub) of shingles in the prefixes of two or more nodes."""
        rows = self.docs.select("text").mapInArrow(_rarest(sketch), "key long, salt int, sig long")
        own = Window.partitionBy("key", "salt")
        return (rows.withColumns({"hub": F.min("sig").over(own), "last": F.max("sig").over(own)})
                .where("hub <> last or salt > 0").groupBy("key", "salt", "sig", "hub").agg(F.count("*").alias("rows"))
                .drop("rows"))

    def texts(self) -> DataFrame:
        """(sig, text) of the nodes that share a block with another."""
        shared = self.blocks.select("sig").distinct()
        wanted = self.nodes.join(shared, "sig", "left_semi").select(
            "sig", F.coalesce("at.doc_id", F.lit(-2 ** 63)).alias("id"), F.col("at.place").alias("place"))
        docs = self.docs.select(F.coalesce("doc_id", F.lit(-2 ** 63)).alias("id"), "place", "text")
        return docs.join(wanted, ["id", "place"]).select("sig", "text")

    def first_pairs(self) -> DataFrame:
        """Each node with the hub it shares most prefix shingles with, of those the points allow."""
        hot = self.blocks.where("salt > 0").select("key", "hub").distinct()
        over = hot.groupBy("key").agg(F.min("hub").alias("top"))
        ties = (self.blocks.select("sig", "hub")
                .unionByName(hot.join(over, "key").select(F.col("hub").alias("sig"), F.col("top").alias("hub")))
                .where("sig <> hub").groupBy("sig", "hub").agg(F.count("*").alias("shared")))
        best = Window.partitionBy("sig").orderBy(F.desc("shared"), "hub")
        few = ties.withColumn("k", F.row_number().over(best)).where("k <= 3").select("sig", "hub")
        node = self.nodes.select("sig", "n", "point")
        hubs = node.select(F.col("sig").alias("hub"), F.col("n").alias("hub_n"), F.col("point").alias("hub_point"))
        bounded = few.join(node, "sig").join(hubs, "hub").mapInArrow(_bounded, "sig long, hub long, bound long")
        return bounded.groupBy("sig").agg(F.max_by("hub", F.struct("bound", -F.col("hub"))).alias("hub"))

    def links_between(self, roots: DataFrame, texts: DataFrame) -> DataFrame:
        """Links between nodes that share a prefix shingle and are not connected yet.

        Candidates are (node, part of another component), so that a node near a large component
        makes one row for each part and not one for each member; each part looks for one link.
        """
        size = roots.groupBy("root").agg(F.count("*").alias("size"))
        placed = materialize(
            self.blocks.select("sig").distinct().join(roots.join(size, "root"), "sig", "left")
            .select("sig", F.coalesce("root", "sig").alias("root"),
                    F.pmod(F.xxhash64("sig"), F.coalesce(F.ceil(F.col("size") / GROUP), F.lit(1))).alias("chunk")),
            "jaccard-placed")
        rows = self.blocks.select("key", "sig").join(placed, "sig")
        open_ = (rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
                 .select("key"))
        rows = materialize(rows.join(open_, "key", "left_semi"), "jaccard-open")
        # Shingles with the same nodes are one block.
        kept = (rows.groupBy("key").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("sig")).alias("x"),
                                        F.bit_xor(F.xxhash64("sig", F.lit(1))).alias("y"))
                .groupBy("m", "x", "y").agg(F.min("key").alias("key"))
                .select("key", F.ceil(F.col("m") / CELL).cast("int").alias("s")))
        cells = (rows.join(kept, "key").withColumn("i", F.pmod(F.xxhash64("sig", "key"), "s").cast("int"))
                 .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
                 .select("key", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"), "sig", "root", "chunk"))
        cells = materialize(cells, "jaccard-cells")
        many = max(1, cells.count() // 4000)
        near = materialize(cells.join(self.nodes.select("sig", "n", "point"), "sig")
                           .groupBy(F.pmod(F.xxhash64("key", "low", "high"), F.lit(many)).alias("g"))
                           .applyInArrow(_between, "sig long, root long, chunk long").distinct(), "jaccard-near")
        of = ["root", "chunk"]
        split = near.groupBy(*of).agg(F.ceil(F.count("*") / GROUP).alias("s"))
        asks = near.join(split, of).select(*of, F.pmod(F.xxhash64("sig", F.lit(2)), "s").alias("g"), "sig")
        part = asks.select(*of, "g").distinct().join(placed, of).select(*of, "g", "sig")
        both = asks.withColumn("asks", F.lit(True)).unionByName(part.withColumn("asks", F.lit(False)))
        return both.join(texts, "sig").groupBy(*of, "g").applyInArrow(_search, "a long, b long")

    def verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """Links found in groups of one hub and some of its partners."""
        size = pairs.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).alias("s"))
        dealt = pairs.join(size, "hub").withColumn("g", F.pmod(F.xxhash64("sig"), "s")).select("hub", "g", "sig")
        members = dealt.unionByName(dealt.select("hub", "g", F.col("hub").alias("sig")).distinct())
        return members.join(texts, "sig").groupBy("hub", "g").applyInArrow(_verify, "a long, b long")

    def run(self) -> DataFrame:
        spark = self.docs.sparkSession
        texts = materialize(self.texts(), "jaccard-texts")
        edges = materialize(self.verified(self.first_pairs(), texts), "jaccard-links")
        roots = components(edges)
        more = materialize(self.links_between(roots, texts), "jaccard-links")
        if more.isEmpty():
            return roots
        return components(more.unionByName(roots.select(F.col("sig").alias("a"), F.col("root").alias("b"))))


def _prepared(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("doc_id"), raw(F.col(text)).alias("text")).withColumn(
        "place", F.xxhash64("text"))


def _known(key: Column | str) -> Column:
    """A null key sorts behind all others."""
    return F.coalesce(key, F.lit(2 ** 63 - 1))


def _least(join: _Join) -> DataFrame:
    """Per set (sig): the smallest key of its component, and the row that stands for it."""
    sets = join.nodes.select("sig", "at").join(join.run(), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    own = F.struct(_known("at.doc_id").alias("id"), F.col("at.place").alias("place"))
    least = sets.groupBy("root").agg(F.min("at.doc_id").alias("component_id"), F.min(own).alias("first"))
    return sets.select("sig", "root").join(least, "root")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, n_shingles and component_id, the smallest key linked with it.

    Two rows link when the Jaccard similarity of their distinct five-word shingles (ASCII-lower-cased
    words) is 0.75 or more; links carry over. Fewer than five words are one shingle; a null, empty or
    blank text has none and is linked with nothing, so its component is itself. Equal texts link. A
    null key is null again and counts for a component only if no other is in it. Repeated rows
    give a row each. An empty table gives no rows.
    """
    join = _Join(_prepared(df, key, text))
    # Sets that many rows share are joined on a narrow row, which Spark may split.
    return (join.members.join(_least(join).select("sig", "component_id"), "sig", "left")
            .select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` less all but one of each component of near duplicates.

    The row with the smallest key stays, of equal keys the one with the smallest text hash, of equal
    rows any. Rows without a word are in no component and all stay.
    """
    first = _least(_Join(_prepared(df, key, text))).select("first.id", "first.place").distinct()
    names = {"id": "__id", "place": "__place"}
    first = first.withColumnsRenamed(names)
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = df.where(worded).withColumns({"__id": _known(F.col(key).cast("long")), "__place": F.xxhash64(raw(F.col(text)))})
    return (rows.join(first, ["__id", "__place"], "left_semi").dropDuplicates(["__id", "__place"]).select(*df.columns)
            .unionByName(df.where(~worded)))
