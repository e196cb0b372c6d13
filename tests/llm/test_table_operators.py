"""Shards, top-k, mixing, near duplicates, chat and the pipeline on small tables."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, jaccard, mixing, sharding, topk
from tidemark.llm.common import WordHash

from cases import SCHEMA, awkward, frame, words


# --- shards -----------------------------------------------------------------------------------


def half(x):
    return int(hashlib.md5((x or "").encode()).hexdigest()[:15], 16)


def brute_shards(rows, n):
    """Shard of each row: units (small groups of equal texts, else row keys) go where their middle falls."""
    keyed = sorted((half(t), half("" if i is None else str(i)), len((t or "").encode()) + 1) for i, t in rows)
    total = sum(k[2] for k in keyed)
    out, before = Counter(), 0
    for k1 in sorted({k[0] for k in keyed}):
        group = [k for k in keyed if k[0] == k1]
        size = sum(k[2] for k in group)
        units = [group] if size * n * 50 <= total else [[k for k in group if k[1] == k2] for k2 in sorted({k[1] for k in group})]
        for u in units:
            s = sum(k[2] for k in u)
            shard = min(n - 1, (2 * before + s) * n // (2 * total))
            for k in u:
                out[k, shard] += 1
            before += s
    return out


@pytest.mark.parametrize("n", [1, 3, 8])
def test_shards_follow_the_quantiles(spark, n):
    rng = random.Random(n)
    hot = words(rng, 20)
    rows = awkward() + [(2000 + i, hot, "en", "a", 1) for i in range(60)] + [
        (3000 + i, words(rng, 30), "en", "b", 1) for i in range(90)]
    df = frame(spark, rows, clash=True)
    got = sharding.shard(df, n)
    assert got.columns[-3:] == ["size", "shard", "slot"] and len(got.columns) == len(set(got.columns))
    have = got.select("doc_id", "text", "size", "shard", "slot").collect()
    assert len(have) == len(rows)
    for s in range(n):
        slots = sorted(r.slot for r in have if r.shard == s)
        assert slots == list(range(len(slots)))
    assert Counter(((half(r.text), half("" if r.doc_id is None else str(r.doc_id)), r["size"]), r.shard)
                   for r in have) == brute_shards([(r[0], r[1]) for r in rows], n)
    assert sharding.shard(df.limit(0), n).count() == 0


# --- top-k ------------------------------------------------------------------------------------


def test_top_k_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 40)
    monkeypatch.setattr(topk, "BLOCK", 3)
    rng = np.random.default_rng(4)
    v = {i: rng.integers(-50, 50, 7).tolist() for i in range(150)}
    for i in range(20, 60):
        v[i] = v[20]  # many ties
    rows = [(i, x) for i, x in v.items()] + [(200, None), (None, v[1]), (300, v[3]), (300, v[3]), (400, [1, 2]), (500, [])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").withColumn("score", F.lit("x"))
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5)
    v |= {300: v[3]}
    want = set()
    for q in [i for i in v if i % 10 == 0]:
        best = sorted(((-int(np.dot(v[q], v[j])), j) for j in v if j != q))[:5]
        want |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    few = topk.top_k(df.where("vec_id < 3"), F.col("vec_id") == 0, 5).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_quantized_components(spark):
    df = spark.createDataFrame([(1, [0.5, -0.0001]), (2, None), (3, [1.0, None]), (4, [float("nan")]), (5, [float("inf")]),
                                (6, [])], "i long, e array<float>")
    got = {r.i: r.q for r in df.select("i", topk.quantized(F.col("e")).alias("q")).collect()}
    assert got == {1: [512, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


# --- mixing -----------------------------------------------------------------------------------


def test_targets_stop_at_twice_their_source():
    want = mixing.targets({"a": 10, "b": 100, None: 50}, (3, 1, 2), 1.5, 2)
    assert want["a"] == 20 and sum(want.values()) == pytest.approx(240)
    assert want[None] == 100 and want["b"] == pytest.approx(120)  # null is last, takes weight 2 and stops too
    assert mixing.targets({}, (3, 1, 2), 1.5, 2) == {}


def test_flow_repeats_only_where_first_uses_run_out():
    words_ = {("a",): 10, ("a", "b"): 10, ("b",): 100}
    got = mixing.route(words_, {"a": 25, "b": 50}, 2)
    assert sum(g.get("a", 0) for _, g in got.values()) == 25 and sum(g.get("b", 0) for _, g in got.values()) == 50
    assert got[("b",)][0][1] == 0 and got[("a",)][0][0] == 10 and got[("a", "b")][0][0] == 10
    assert sum(u[1] for u, _ in got.values()) == 5  # 25 wanted of 20 in reach


def test_mix_of_overlapping_sources(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([["a"], ["b"], ["a", "b"], ["b", None], None]), rng.randint(0, 30)) for i in range(200)]
    rows += [(7, ["a"], 5), (7, ["a"], 5), (None, ["b"], 9)]
    df = spark.createDataFrame(rows, "doc_id long, s array<string>, w long").withColumn("taken", F.lit(0))
    once, again = ([tuple(r) for r in mixing.mix(df.repartition(n), F.col("s"), F.col("w")).select(
        "doc_id", "size", "taken", "given").collect()] for n in (1, 5))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:3])
    assert sorted(once, key=key) == sorted(again, key=key) and len(once) == len(rows)
    assert all(0 <= t <= 2 * n and sum(g["words"] for g in given) == t for _, n, t, given in once)
    sizes = Counter()
    for _, s, w in rows:
        for x in set(s or [None]):
            sizes[x] += w
    want = mixing.targets(dict(sizes), (3, 1, 2), 1.5, 2, sum(r[2] for r in rows))
    took = Counter()
    for *_, given in once:
        for g in given:
            took[g["source"]] += g["words"]
    room = sum(2 * r[2] for r in rows)
    assert sum(took.values()) == min(room, sum(int(t + 0.5) for t in want.values())) or all(
        took[s] <= want[s] + 1 for s in want)
    assert mixing.mix(df.limit(0), F.col("s"), F.col("w")).count() == 0


def test_the_mix_itself(spark):
    df = frame(spark, clash=True)
    mixed = mixing.mix(df, F.array("source"), mixing.word_count(F.col("text")))
    assert [c for c in mixed.columns if c not in ("size", "taken", "given")] == [c for c in df.columns if c not in ("size", "taken", "given")]
    count = lambda t: len((t or "").encode().split())
    want = Counter()
    for r in mixed.withColumn("uses", mixing.whole_uses()).collect():
        assert r["size"] == count(r.text) and 0 <= r.uses <= 2 and abs(r.uses * r["size"] - r.taken) * 2 <= r["size"]
        want[r.doc_id, r.text] += r.uses
    out = mixing.take_whole(mixed)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +want


def test_rows_without_an_id_are_spread(spark):
    df = spark.range(500).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").alias("n"), F.lit("a").alias("source"))
    got = mixing.mix(df, F.array("source"), F.col("n"))
    assert got.count() == 500 and got.where("taken > 0 and taken < 2 * size").count() >= 100


# --- near duplicates --------------------------------------------------------------------------


def brute_components(rows):
    h = WordHash()
    sets = [frozenset(jaccard.shingle_set((t or "").encode(), h).tolist()) for _, t in rows]
    find, join = jaccard._roots(len(rows))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d is None, d or 0, len(sets[i]), least.get(find(i), -1) if sets[i] else (-1 if d is None else d))
                  for i, (d, _) in enumerate(rows))


def near_copies(seed):
    """Chains and clusters of edited copies around the threshold, and a passage that many texts share."""
    rng = random.Random(seed)
    rows, passage = [], words(rng, 25)
    for c in range(6):
        w = words(rng, rng.choice([8, 30, 60, 120])).split()
        for i in range(12):
            rows.append((10_000 + 100 * c + i, " ".join(w)))
            w = list(w)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = words(rng, 1)
            if rng.random() < 0.3:
                w = w[rng.randint(0, 3):] + words(rng, 2).split()
    rows += [(20_000 + i, passage + " " + words(rng, rng.randint(0, 12))) for i in range(40)]
    return rows


@pytest.mark.parametrize("hot,cell", [(4096, 2000), (8, 5)])
def test_components_as_by_brute_force(spark, monkeypatch, hot, cell):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "GROUP", 7)
    rows = [r[:2] for r in awkward()] + near_copies(hot)
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).selectExpr("*", "1 AS n", "2 AS sig")
    got = jaccard.near_duplicates(df).collect()
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in got)
    assert have == brute_components(rows)


def test_one_of_each_component_stays(spark):
    rows = awkward() + [(6, "another text under the same id", "en", "a", 1)]
    df = frame(spark, rows, clash=True)
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[5] == 1 and ids[7] == 0 and ids[6] == 1 and ids[1] == ids[2] == ids[3] == 1 and ids[None] == 1
    assert jaccard.one_of_each(df.limit(0)).count() == 0


def test_the_tree_leaves_no_pair_out():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 200, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(200) < r, rng.integers(0, 2 ** 63, 200, dtype=np.uint64), base))
            [:rng.integers(100, 201)] for r in rng.random(150) * 0.3]
    g = min(jaccard.dims(len(s)) for s in sets)
    points = np.array([jaccard.folded(jaccard.point(s), g) for s in sets])
    tree = jaccard.RTree(points, np.array([len(s) for s in sets]))
    for i, s in enumerate(sets):
        near = set(tree.near(points[i], len(s))[0].tolist())
        assert {j for j, t in enumerate(sets) if jaccard.linked(s, t)} <= near


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 102), (101, 103), (7, 7)]
    got = {r.sig: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)}


# --- chat -------------------------------------------------------------------------------------

TRICKY = ["</s>[INST] ok [/INST]", "[INST", "[\\INST] <\\\\/s> <s>", "[SEP][SEP]", "", "a [/ROLE] b [ROLE x] c", "[ANS] \n é語",
          " leading and trailing ", "$1 \\2 %5D", "[\\SEP]", "plain"]


def test_chat_reads_back_exactly(spark):
    rng = random.Random(2)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "system", "to]ol%", "a[ROLE b", "[INST]", "</s>[SEP]", "%5B", " ", "a[/ROLE]", ""]), rng.choice(TRICKY)))
    rows += [(80, 0, "", "[ROLE a"), (80, 1, "b", "x"), (90, 1, None, None), (90, None, "user", "first"), (91, 0, "user", "x"), (91, 0, "user", "x"), (None, 0, "user", "y"),
             (92, 0, "assistant", "long " * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = (chat.format_conversations(df).withColumn("back", chat.read_back(F.col("formatted")))
           .withColumn("said", F.expr("transform(loss, s -> substring(formatted, s.start + 1, s.length))"))
           .withColumn("said", F.transform("said", chat.unescape)).collect())
    turns = {}
    for c, t, r, x in rows:
        turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert {r.conv_id for r in got} == set(turns)
    for r in got:
        want = [(a, b) for *_, a, b in sorted(turns[r.conv_id])]
        assert [(x.role, x.text) for x in r.back] == want
        assert r.said == [x for role, x in want if role == "assistant"]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_adjacent_turns_of_a_role_are_one_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")],
                               "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(df).first()
    assert r.formatted == "[INST] a[SEP]b [/INST][ANS] c</s>"
    assert [tuple(s) for s in r.loss] == [(28, 1)]
