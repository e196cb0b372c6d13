"""Lexical search, hard negatives and packing against brute force on small tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, lexical, negatives, packing

from cases import awkward, frame, words


# --- lexical search ---------------------------------------------------------------------------


def found_terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(docs, items, k):
    held = [(i, Counter(found_terms(t))) for i, t in docs if found_terms(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            n, score = sum(c.values()), 0
            m = 100 - 25 + (25 * n * n_docs) // length
            for t in found_terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if gone else i, -s) for r, (s, gone, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


ITEMS = [(1, "Ka lo mi, RA tu; ve no si"), (2, "kalo mira! kalo kalo kalo"), (3, None), (4, ""), (5, "?!"), (6, "absentterm"),
         (7, "Ünïcödé 語 no id"), (8, "kalo"), (8, "kb never there"), (None, "ka ka tu"), (9, "no id here at all two words")]
ASKED = [x for x in ITEMS if x[0] != 8] + [(8, "kalo")]


@pytest.mark.parametrize("block", [8 << 20, 20])
def test_search_as_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    rows = awkward() + [(500 + i, words(random.Random(i % 4), 12), "en", "a", 1) for i in range(40)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("rank", F.lit("x"))
    got = lexical.rank(frame(spark, rows, clash=True), items, 5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_search([r[:2] for r in rows], ASKED, 5)
    assert lexical.rank(frame(spark).limit(0), items, 5).count() == 0
    assert lexical.rank(frame(spark), items.limit(0), 5).count() == 0


def test_accumulators_are_limited_and_survivors_exact(monkeypatch):
    rng = np.random.default_rng(5)
    tf = np.where(rng.random((400, 12)) < np.linspace(0.01, 0.9, 12), rng.integers(1, 9, (400, 12)), 0)
    n = tf.sum(axis=1) + 5
    df = (tf > 0).sum(axis=0)
    weight = np.array([math.floor(1000 * math.log(802 / (2 * x + 1))) for x in df])
    length = int(n.sum())
    m = 75 + 25 * n * 400 // length
    exact = (weight * (10 ** 9 * tf // (1000 * tf + 12 * m[:, None]))).sum(axis=1)
    place, term = np.nonzero(tf)
    ends = np.append(0, np.cumsum((tf > 0).sum(axis=1)))
    chunk = lexical.Chunk(n, term, tf[place, term], ends, weight, 400, length)
    item = lexical.Item(1, np.argsort(df, kind="stable"), np.ones(12, np.int64))
    acc, opened = chunk.scores(item, 5, 1)
    best = np.argsort(-exact, kind="stable")[:5]
    assert opened < 12 and (acc > 0).sum() < (exact > 0).sum()
    assert (acc[best] == exact[best]).all() and (acc <= exact).all()
    # A floor from earlier chunks closes sooner.
    assert chunk.scores(item, 5, int(exact.max()))[1] <= opened
    # The same best documents whatever the chunks.
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(400)), pa.array(n), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(term)),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tf[place, term]))], names=["doc_id", "n", "terms", "tf"])
    for size in (3, 50, 1000):
        monkeypatch.setattr(lexical, "CHUNK", size)
        out = pa.Table.from_batches(lexical._searcher([item], weight, 400, length, 5)(iter([batch])))
        want = sorted((-s, i) for i, s in enumerate(exact.tolist()))[:5]
        assert list(zip(out["doc_id"].to_pylist(), out["score"].to_pylist())) == [(i, -s) for s, i in want]


# --- hard negatives ---------------------------------------------------------------------------


def brute_negatives(rows, k, m):
    seen = {}
    for i, label, v in rows:
        if None not in (i, label, v) and v:
            seen[i] = min(seen.get(i, (label, v)), (label, v))
    out = set()
    for a in [i for i in seen if i % 10 == 0]:
        dot = lambda j: sum(x * y for x, y in zip(seen[a][1], seen[j][1]))  # noqa: E731,B023
        others = [j for j in seen if j != a and len(seen[j][1]) == len(seen[a][1])]
        for p in sorted((-dot(j), j) for j in others if seen[j][0] == seen[a][0])[:k]:
            ps = -p[0]
            near = sorted((-dot(j), j) for j in others if seen[j][0] != seen[a][0] and 80 * ps <= 100 * dot(j) <= 100 * ps)
            out |= {(a, p[1], r + 1, j, ps, -s) for r, (s, j) in enumerate(near[:m])}
    return out


@pytest.mark.parametrize("dim", [1, 5, 16, 37])
def test_negatives_as_by_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(negatives, "CHUNK", 60)
    monkeypatch.setattr(negatives, "BLOCK", 7)
    rng = np.random.default_rng(dim)
    centre = rng.integers(-200, 200, (4, dim))
    rows = [(i, int(rng.integers(0, 3)), (centre[i % 4] + rng.integers(-60, 60, dim)).tolist()) for i in range(220)]
    rows += [(300 + i, 1, rows[20][2]) for i in range(12)]  # many ties
    rows += [(330, 2, rows[20][2])] * 2 + [(330, 1, rows[21][2]), (None, 1, rows[0][2]), (340, None, rows[0][2]), (350, 1, None),
                                           (360, 1, []), (370, 1, [3] * (dim + 1)), (380, 0, [0] * dim)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").withColumn("mean", F.lit("x"))
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, 4, 3)
    assert {tuple(r) for r in got.collect()} == {(a, p, r, n, ps, ns) for a, p, r, n, ps, ns in brute_negatives(rows, 4, 3)}
    assert negatives.mine(df.limit(0), F.lit(True)).count() == 0


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(1)
    v = (rng.integers(-300, 300, (80, 64)) + np.repeat(rng.integers(-500, 500, (80, 4)), 16, axis=1)).astype(np.int64)
    v[7] = 0
    s = negatives.Summaries(64, *negatives.summarize(v))
    exact, wide = v @ v.T, []
    for level in range(len(negatives.LEVELS)):
        low, high = negatives.bounds(s, s, level)
        assert (low <= exact).all() and (exact <= high).all()
        wide.append((high - low).mean())
    assert wide == sorted(wide, reverse=True)


def test_bounds_spare_exact_scores():
    rng = np.random.default_rng(2)
    centre = np.repeat(rng.integers(-200, 200, (20, 16)), 4, axis=1)
    v = centre[np.arange(2000) % 20] + rng.integers(-30, 30, (2000, 64))
    mean, dev = negatives.summarize(v)
    t = pa.table({"id": np.arange(2000), "label": np.arange(2000) % 3, **{
        n: pa.array(list(x), pa.list_(pa.from_numpy_dtype(x.dtype))) for n, x in (("v", v), ("mean", mean), ("dev", dev))}})
    search = negatives.Search(t.slice(0, 100), t)
    found = {int(a[0]): s for a, _, s in search.positives(5)}
    assert len(found) == 100 and search.scored < 100 * 667 * 0.2
    for a in (0, 17, 99):
        own = v[a::3] @ v[a] if a < 3 else v[a % 3::3] @ v[a]
        want = sorted(own.tolist(), reverse=True)
        want.remove(int(v[a] @ v[a]))
        assert sorted(found[a].tolist(), reverse=True) == want[:5]


# --- packing ----------------------------------------------------------------------------------


def check_packed(rows, limits, cut=True):
    """Pieces tile texts and sequences, limits hold; gives the padding and all lengths."""
    texts, seqs = {}, {}
    for r in rows:
        texts.setdefault(r.doc, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    for pieces in texts.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and len(p.ids) == 4 * p.length
            at += p.length
        assert at == pieces[0].doc_tokens
    padding = 0
    for pieces in seqs.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(p.loss_tokens for p in pieces) <= limits.loss
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding, sum(r.length for r in rows), len(seqs)


def test_texts_pack_without_padding(spark):
    rows = awkward() + [(600 + i, words(random.Random(i), 1 + i % 300), "en", "a", 1) for i in range(200)]
    rows += [(900, words(random.Random(0), 120_000) + "x" * 300_000, "en", "a", 1)]
    df = frame(spark, rows, clash=True).withColumn("offset", F.lit("x")).repartition(3).withColumn(
        "doc", F.monotonically_increasing_id())
    got = packing.pack_texts(df, keep=["doc", "doc_id", "text", "offset"])
    have = got.collect()
    assert "offset" in got.columns and len(got.columns) == len(set(got.columns)) == 10
    padding, total, _ = check_packed(have, packing.Limits())
    assert padding == 0 and len({r.doc for r in have}) == len(rows)
    tok = packing._tokenizer(packing.TOKENIZER)
    for r in have:
        if len(r.text or "") < 400_000 or r.start == 0:
            ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
            assert r.doc_tokens == len(ids)
            assert zlib.crc32(r.ids) == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert packing.pack_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("limits", [packing.Limits(64, 4, 64), packing.Limits(64, 50, 20), packing.Limits(100, 3, 10)])
@pytest.mark.parametrize("cut", [True, False])
def test_all_limits_hold(limits, cut):
    rng = np.random.default_rng(3)
    packer, got = packing.Packer(limits, cut), []
    source = pa.RecordBatch.from_pydict({"d": pa.array(range(300))})
    for i in range(300):
        n = int(rng.integers(1, 20)) if i % 10 else int(rng.integers(50, 400))
        mask = rng.random(n) < rng.random()
        packer.add(packing.Example(np.arange(n, dtype=np.uint32), np.append(0, np.cumsum(mask)), source, i))
        got += list(packer.sequences(2000))
    got += list(packer.sequences())
    covered = {i: [] for i in range(300)}
    for s in got:
        size = sum(b - a for _, a, b in s)
        assert 0 < size <= limits.tokens and len(s) <= limits.segments and sum(e.loss(a, b) for e, a, b in s) <= limits.loss
        assert not cut or size == limits.tokens or size & (size - 1) == 0
        for e, a, b in s:
            covered[e.row].append((a, b))
            over = len(e.ids) > limits.tokens or e.loss(0, len(e.ids)) > limits.loss
            assert cut or over or (a, b) == (0, len(e.ids))
    for e, spans in covered.items():
        spans.sort()
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_the_dot_product_takes_what_fills_both_resources():
    pool, source = packing.Pool(), pa.RecordBatch.from_pydict({"d": pa.array([0])})
    for n, loss in ((10, 10), (40, 0), (30, 30)):
        pool.add(packing.Example(np.zeros(n, np.uint32), np.append(0, np.cumsum(np.arange(n) < loss)), source, 0), 0, n)
    lim = packing.Limits(100, 9, 40)
    assert pool.size[pool.best(lim, lim)] == 30  # 0.3 + 0.75 beats 0.4 + 0
    assert pool.size[pool.best(packing.Limits(100, 9, 5), lim)] == 40  # little loss is left
    assert pool.best(packing.Limits(9, 9, 40), lim) is None


def test_long_texts_are_tokenized_as_a_whole(monkeypatch):
    rng = random.Random(8)
    bits = ["word", "Don't", "12 345", "  ", "\n\n", " x", "é語", "—", "<|endoftext|>", "...", "\t", "'s", " "]
    text = "".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(4000))
    cut = packing.parts(text, 50)
    assert len(cut) > 100 and "".join(cut) == text
    tok = packing._tokenizer(packing.TOKENIZER)
    want = tok.encode(text, add_special_tokens=False).ids
    assert [i for p in cut for i in tok.encode(p, add_special_tokens=False).ids] == want
    assert packing._encoder(packing.TOKENIZER).encode_to_numpy(text, allowed_special="all").tolist() == want
    monkeypatch.setattr(packing, "PART", 50)
    assert packing.encode(["", text, "a"])[1].tolist() == want + [1]
    assert packing.encode([""])[0].tolist() == [1] and packing.encode([]) == []


def test_ids_are_the_tokenizers_own(sf):
    texts = [t or "" for t in pq.read_table(f"{sf}/documents.parquet", columns=["text"]).column(0).to_pylist()]
    texts += ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 5000, " " * 500_000 + "a", "\r\n \t x", "\u0000\u00ad\u200b\ufeff", "𝔘 🙂👍🏽"]
    tok = packing._tokenizer(packing.TOKENIZER)
    want = [e.ids + [1] for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in packing.encode(texts)] == want


def test_conversations_pack_whole_under_a_loss_limit(spark):
    rng = random.Random(4)
    rows = [(c, t, ("user", "assistant")[t % 2], words(rng, rng.randint(0, 120))) for c in range(80) for t in range(rng.randint(1, 6))]
    rows += [(90, 0, "user", None), (91, 0, "assistant", words(rng, 2000)), (None, 0, "assistant", "y")]
    df = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    limits = packing.Limits(1024, 16, 400)
    got = packing.pack_conversations(df.withColumn("doc", F.coalesce("conv_id", F.lit(-1))), limits=limits)
    have = got.collect()
    check_packed(have, limits)
    pieces = Counter(r.doc for r in have)
    assert pieces[91] > 1 and len(pieces) == df.count()
    tok = packing._tokenizer(packing.TOKENIZER)
    for r in have:
        if pieces[r.doc] == 1:
            said = sum(len(tok.encode(r.formatted[s.start:s.start + s.length]).ids) for s in r.loss)
            assert abs(r.loss_tokens - said) <= 2 * len(r.loss) + 1
            assert (r.loss_tokens > 0) == bool(len(r.loss))
    assert packing.pack_conversations(df.limit(0)).count() == 0
