"""Byte-balanced shards by histogram sort, in DataFrame operations only.

Rows are ordered by a hash of their text and then of their id, so that equal texts stand together.
The splitters between shards are found by counting bytes in ever narrower key ranges around each
wanted quantile, all ranges in one pass; a range is refined until it holds a single group of equal
texts small enough to stay whole, or a single row key. Rows then cross one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import raw

#: Bits of a key half, and bits by which one counting pass narrows a range.
BITS, STEP = 60, 12
#: A group of equal texts stays in one shard if it holds at most this share of a shard's bytes.
WHOLE = (1, 50)


def half_key(text: Column) -> Column:
    """The first 60 bits of the text's md5 as a number; null counts as empty."""
    return F.conv(F.substring(F.md5(raw(text)), 1, BITS // 4), 16, 10).cast("long")


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _count(rows: DataFrame, ranges: list[tuple[int, int, int | None]]) -> dict[int, list]:
    """Bytes and rows in each part of each range, in key order.

    A range is (shift, prefix, group): rows with ``k1 >> shift == prefix``, or where group is not
    None those of that text group with ``k2 >> shift == prefix``; parts are 2**STEP times narrower.
    """
    which = F.lit(None).cast("int")
    part = F.lit(None).cast("long")
    for i, (shift, prefix, group) in reversed(list(enumerate(ranges))):
        k = F.col("k1" if group is None else "k2")
        here = F.shiftright(k, shift) == prefix if shift < BITS else F.lit(True)
        if group is not None:
            here = here & (F.col("k1") == group)
        which = F.when(here, i).otherwise(which)
        part = F.when(here, F.shiftright(k, shift - STEP)).otherwise(part)
    got = (rows.select(which.alias("i"), part.alias("part"), "k1", "k2", "size").where("i is not null")
           .groupBy("i", "part").agg(
               F.sum("size").alias("bytes"), F.min("k1").alias("low1"), F.max("k1").alias("high1"),
               F.min("k2").alias("low2"), F.max("k2").alias("high2")).collect())
    out: dict[int, list] = {}
    for r in sorted(got, key=lambda r: (r.i, r.part)):
        out.setdefault(r.i, []).append(r)
    return out


def splitters(rows: DataFrame, total: int, shards: int) -> list[tuple[int, int]]:
    """Keys at which shards 1.. begin. Ranges of equal place and width are counted once."""
    found: dict[int, tuple[int, int]] = {}
    open_: dict[int, tuple[tuple, int]] = {j: ((BITS, 0, None), 0) for j in range(1, shards)}
    while open_:
        ranges = sorted({x[0] for x in open_.values()}, key=str)
        counts = _count(rows, ranges)
        at = {r: i for i, r in enumerate(ranges)}
        going = {}
        for j, (rng, before) in open_.items():
            for c in counts[at[rng]]:
                if (before + c.bytes) * shards > total * j:
                    break
                before += c.bytes
            one_group, one_key = c.low1 == c.high1, c.low1 == c.high1 and c.low2 == c.high2
            small = c.bytes * shards * WHOLE[1] <= total * WHOLE[0]
            shift = rng[0] - STEP
            if one_key or one_group and rng[2] is None and small:
                right = (2 * before + c.bytes) * shards >= 2 * total * j
                found[j] = (c.low1, 0 if small and rng[2] is None else c.low2) if right else (
                    (c.high1 + 1, 0) if rng[2] is None and small else (c.high1, c.high2 + 1))
            elif one_group and rng[2] is None:
                going[j] = ((BITS, 0, c.low1), before)
            else:
                going[j] = ((shift, c.part, rng[2]), before)
        open_ = going
    return [found[j] for j in range(1, shards)]


def _shard(bounds: list[tuple[int, int]]) -> Column:
    if not bounds:
        return F.lit(0)
    all_ = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in bounds])
    return F.size(F.filter(all_, lambda x: (F.col("k1") > x.a) | ((F.col("k1") == x.a) & (F.col("k2") >= x.b))))


def _hot_groups(rows: DataFrame, n: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Text groups of more rows than an even share of a cell, by cell; at most 2**STEP of them."""
    per = max(1, n >> STEP)
    bins = rows.groupBy(F.shiftright("k1", BITS - STEP).alias("bin")).agg(F.count("*").alias("n"))
    full = [r.bin for r in bins.where(F.col("n") > 4 * per).collect()]
    if not full:
        return []
    hot = (rows.where(F.shiftright("k1", BITS - STEP).isin(full)).groupBy("k1").agg(F.count("*").alias("n"))
           .where(F.col("n") > 2 * per).collect())
    out: dict[int, list] = {}
    for r in sorted(hot):
        out.setdefault(r.k1 >> (BITS - STEP), []).append((r.k1, min(STEP, (r.n // per).bit_length())))
    return sorted(out.items())


def shard(df: DataFrame, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows of ``df`` with ``size`` (text bytes plus one), ``shard`` and gapless ``slot`` added.

    Columns of those names are replaced. A null or empty text has size 1, a null id counts as the
    empty text. Rows equal in text and id cannot be told apart and stay together. An empty table
    gives an empty result. Shards differ from an even share by less than one such unit.
    """
    names = {c: f"__kept{i}" for i, c in enumerate(df.columns) if c.lower() not in ("size", "shard", "slot")}
    kept = [F.col(n).alias(c) for c, n in names.items()]
    keyed = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], half_key(df[text]).alias("k1"),
                      half_key(df[key].cast("string")).alias("k2"), text_bytes(df[text]).alias("size"))
    rows = materialize(keyed.select("k1", "k2", "size"), "shard-keys")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    bounds = splitters(rows, total, shards) if total else []
    hot = _hot_groups(rows, n)
    spark = df.sparkSession
    hots = spark.createDataFrame(hot, "bin long, hots array<struct<k:long,bits:int>>")

    def celled(x: DataFrame) -> DataFrame:
        """Cells in key order, none much larger than 2**-STEP of the rows."""
        x = x.withColumn("bin", F.shiftright("k1", BITS - STEP))
        if hot:
            x = x.join(F.broadcast(hots), "bin", "left")
            lower = F.filter("hots", lambda h: h.k < F.col("k1"))
            same = F.filter("hots", lambda h: h.k == F.col("k1"))
            x = x.withColumns({"part": F.coalesce(2 * F.size(lower) + F.size(same), F.lit(0)),
                               "sub": F.coalesce(F.expr("shiftright(k2, 60 - get(filter(hots, h -> h.k = k1), 0).bits)"),
                                                 F.lit(0).cast("long"))}).drop("hots")
        else:
            x = x.withColumns({"part": F.lit(0), "sub": F.lit(0).cast("long")})
        return x.withColumn("shard", _shard(bounds))

    cell = ["shard", "bin", "part", "sub"]
    counts = sorted(tuple(r) for r in celled(rows).groupBy(*cell).agg(F.count("*").alias("n")).collect())
    offsets, at, last = [], 0, None
    for s, b, p, u, m in counts:
        at = at if s == last else 0
        offsets.append((s, b, p, u, at))
        at, last = at + m, s
    starts = spark.createDataFrame(offsets, "shard int, bin long, part int, sub long, offset long")
    order = Window.partitionBy(*cell).orderBy("k1", "k2")
    return (celled(keyed).join(F.broadcast(starts), cell)
            .withColumn("slot", F.col("offset") + F.row_number().over(order) - 1)
            .select(*kept, "size", "shard", "slot"))
