"""Thin queries over the given tables, one for each operator, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from . import (chat, decontaminate, jaccard, langid, lattice, lexical, mixing, negatives, packing, pseudonyms, sharding,
               topk, toxicity)
from .common import fold, raw, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


#: The key of the pseudonyms; a deployment sets its own in this session setting.
PII_KEY = "spark.tidemark.pii.key"


@query()
def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key = spark.conf.get(PII_KEY, "tidemark").encode()
    return pseudonyms.pseudonymize(docs, key, keep=["doc_id"]).select("doc_id", "text", "found")


@query()
def op2_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = fold(F.col("doc_id"), 5) == 0
    profiles = langid.fit_profiles(docs.where(~out))
    got = langid.identify(docs.select("doc_id", "text", out.alias("held_out")), profiles)
    return got.select("doc_id", "held_out", "lang_pred", "score")


SHARDS = 16


@query()
def op3_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(raw(F.col("text"))).alias("text_crc32")
    return (sharding.shard(docs.select("doc_id", "text", crc), SHARDS)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


@query()
def op4_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = fold(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, labels, ~out)
    got = toxicity.score(docs.select("doc_id", "text", out.alias("held_out")), model, keep=["doc_id", "held_out"])
    return got.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(range(1, len(v.e) + 1), lambda i: q.e[i] * v.e[i])) AS BIGINT) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""")
def op5_uniform_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select(
        "vec_id", topk.quantized(F.col("embedding")).alias("vector"))
    return topk.top_k(v, F.col("vec_id") % 100 == 0, 10)


@query()
def op6_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (lattice.score(docs, fold(F.col("doc_id"), 7) != 2)
            .select(F.col("key").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                    "train_tokens", "base_score", "score", "lattice_score"))


@query(r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('mix|' || doc_id) AS draw
  FROM documents),
s AS (
  SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS k
  FROM d GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS wt FROM s),
o AS (SELECT *, 2.0 * n / wt AS cap FROM w),
c AS (  -- sources that stop at twice their size are those with the least room a unit of weight
  SELECT *, 1.5 * sum(n) OVER () AS pool, row_number() OVER (ORDER BY cap, k) AS p,
         coalesce(sum(2.0 * n) OVER (ORDER BY cap, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         sum(wt) OVER (ORDER BY cap, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wt_from
  FROM o),
u AS (SELECT min(p) AS p FROM c WHERE (pool - full_before) / wt_from <= cap),
t AS (
  SELECT c.source, c.n, CASE WHEN c.p < u.p THEN 2.0 * c.n ELSE
         c.wt * (SELECT (pool - full_before) / wt_from FROM c JOIN u ON c.p = u.p) END AS target
  FROM c, u),
x AS (
  SELECT d.doc_id, d.size, t.n, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS want,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, round(CAST(target AS DOUBLE), 3) AS target,
       CAST(CASE WHEN size > 0 THEN size * ((2 * (greatest(0, least(size, least(want, n) - start))
                                                 + greatest(0, least(size, want - n - start))) + size) // (2 * size)) ELSE 0 END AS BIGINT) AS taken
FROM x""")
def op7_min_cost_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    rows = materialize(rows, "mix-sizes")
    mixed = mixing.mix(rows.withColumnRenamed("size", "words"), F.array("source"), F.col("words"))
    sizes = {r.source: r.n for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    want = mixing.targets(sizes, (3, 1, 2), 1.5, 2)
    known = spark.createDataFrame([(s, sizes[s], float(want[s])) for s in sizes],
                                  "s string, source_size long, target double")
    return (mixed.join(known, F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "size", "source_size", F.round("target", 3).alias("target"),
                    (F.col("size") * mixing.whole_uses()).alias("taken")))


@query()
def op8_count_vector_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query(r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|ANS\]|/?ROLE[ \]]|SEP\]|/?s>)', '\1\\\2\3', 'g')) AS n,
         lag(role) OVER w AS was, lead(role) OVER w AS next
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(n + CASE WHEN was = role THEN 5 WHEN role = 'user' THEN 7 WHEN role = 'assistant' THEN 6
                         ELSE 8 + length(replace(replace(replace(role, '%', '%25'), '[', '%5B'), ']', '%5D')) END
                  + CASE WHEN next = role THEN 0 WHEN role = 'user' THEN 8 WHEN role = 'assistant' THEN 4
                         ELSE 7 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op9_relational_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    got = (chat.format_conversations(turns)
           .withColumn("turns", chat.read_back(F.col("formatted")))
           .withColumn("said", F.transform("loss", lambda s: chat.unescape(
               F.substring(F.col("formatted"), s.start + 1, s.length)))))
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = F.array_join("said", "")
    return got.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query()
def op10_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return (decontaminate.find_items(docs, items, keep=["doc_id"])
            .select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*"))


@query(r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
d AS (SELECT doc_id, terms, len(terms) AS n FROM t WHERE len(terms) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM d),
i AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)) GROUP BY ALL),
p AS (
  SELECT doc_id, 75 + (25 * n * docs) // len AS m, term, count(*) AS tf
  FROM (SELECT doc_id, n, row_number() OVER () AS k, unnest(terms) AS term FROM d), s GROUP BY k, doc_id, n, docs, len, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s GROUP BY term, docs),
c AS (
  SELECT item_id, doc_id, m, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term) GROUP BY item_id, doc_id, m),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20""")
def op11_accumulator_limited_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


@query("""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         CAST(list_sum(list_transform(range(1, len(v.e) + 1), lambda i: a.e[i] * v.e[i])) AS BIGINT) AS score
  FROM v a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
  WHERE p.k <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op12_segment_summary_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    v = table(spark, sf_dir, "embeddings").select(
        "vec_id", topk.quantized(F.col("embedding"), 256).alias("vector"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return negatives.mine(v, F.col("vec_id") % 100 == 0)


@query()
def op13_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_texts(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
