"""The pipeline's stages against what they promise, and the registered queries' shapes."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidemark.llm import jaccard, mixing, queries
from tidemark.llm.common import WordHash, fold

from cases import CLASHING, frame, words
from test_text_operators import brute_items


def test_stages_each_keep_their_promise(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {"documents": docs}
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.materialize(stage(spark, docs, sf), "test")
        assert docs.columns == columns
        seen[name] = docs
    last = pipeline.STAGES[-1][1](spark, docs, sf)
    text = lambda d: {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    known = text(seen["language_id"])
    assert {i for i, t in text(seen["documents"]).items() if any(c.isalpha() for c in t or "")} == set(known)
    # One of each component.
    h = WordHash()
    sets = {i: jaccard.shingle_set((t or "").encode(), h) for i, t in known.items()}
    groups = {r.doc_id: r.component_id for r in jaccard.near_duplicates(seen["language_id"]).collect()}
    unique = text(seen["ngram_jaccard_join"])
    assert set(unique) == set(groups.values())
    assert not any(jaccard.linked(sets[i], sets[j]) for i in list(unique)[:60] for j in unique if i < j and len(sets[i]) and len(sets[j]))
    # No benchmark item is left, and nothing else went.
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = text(seen["benchmark_decontamination"])
    found = {d for d, _ in brute_items([(i, t) for i, t in unique.items() if len(t) < 1500], items)}
    assert found.isdisjoint(clean)
    assert set(unique) - set(clean) >= found
    assert last.count() == seen["source_mix"].count() and {r.shard for r in last.select("shard").distinct().collect()} == set(range(16))


def test_awkward_rows_go_through_all_stages(spark, sf):
    docs = frame(spark, clash=True)
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        docs = pipeline.materialize(stage(spark, docs, sf), "test")
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.where(" or ".join(f"{c} <> 'x'" for c in CLASHING)).count() == 0
    assert docs.count() > 0 and {r.n for r in docs.select("n").collect()} == {"x"}
    assert docs.columns == [c for c in columns if c not in ("size", "shard", "slot")] + ["size", "shard", "slot"]
    empty = frame(spark).limit(0)
    for name, stage in pipeline.STAGES:
        empty = pipeline.materialize(stage(spark, empty, sf), "test")
    assert empty.count() == 0


def test_a_language_whose_documents_fall_in_one_fold_has_a_profile(spark, sf):
    few = [r.id for r in spark.range(300, 400).where(fold(F.col("id"), 5) == 0).collect()][:6]
    rows = [(i, words(random.Random(i), 60), "en", "a", 1) for i in range(20)]
    rows += [(i, words(random.Random(i), 60, ("xyq", "wzx", "qyw")), "zz", "a", 1) for i in few]
    kept = {r.doc_id for r in pipeline.language(spark, frame(spark, rows), sf).collect()}
    assert kept == {r[0] for r in rows}


def test_the_mix_holds_whole_documents_near_the_targets(spark, sf):
    rows = [(i, words(random.Random(i), 3 + i % 40), "en", "abc"[i % 3], 1) for i in range(300)]
    rows.append((999, words(random.Random(9), 3000), "en", "d", 1))
    docs = frame(spark, rows)
    got = pipeline.mixed(spark, docs, sf).collect()
    text = {r[0]: r[1] for r in rows}
    assert got and all(r.text == text[r.doc_id] for r in got)
    assert max(Counter(r.doc_id for r in got).values()) <= 2
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    for r in got:
        taken[r.source] += len(r.text.split())
    want = mixing.targets(sizes, (3, 1, 2), 1.5, 2)
    assert all(abs(taken[s] - want[s]) <= (1500 if s == "d" else 42) for s in want)


def test_every_operator_has_its_query():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", ["op1_feistel_pseudonyms", "op6_subword_lattice", "op8_count_vector_jaccard"])
def test_queries_cover_every_document(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
