"""Judging a challenger against a champion on paired requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import CANARY
from ..operators.metrics import rank_agreement
from ..operators.orderstats import floor_rank, order_statistics
from ..operators.ranking import ranked


def response_ranks(responses: DataFrame, request: str, item: str) -> DataFrame:
    """Rank per request from any response: the given rank, else position by score.

    ``responses``: request, item, given_rank (nullable), score (nullable).
    """
    r = ranked(responses, [request], [F.col("score").desc_nulls_last(), F.col(item)], "_by_score")
    return r.select(request, item, F.coalesce("given_rank", "_by_score").alias("rank"))


def paired_ranks(responses: DataFrame, request: str, item: str, a: Column, b: Column) -> DataFrame:
    """``response_ranks`` of two arms whose scores stand in one row per request and item, as ``a`` and ``b``; no join."""
    s = responses.select(request, item, a.alias("_a"), b.alias("_b"))
    for score, out in (("_a", "a"), ("_b", "b")):
        s = ranked(s, [request], [F.col(score).desc_nulls_last(), F.col(item)], out)
    return s.select(request, item, "a", "b")


def summarise(samples: DataFrame, arm: str = "arm") -> DataFrame:
    """Per arm: volume, errors and floor-index latency percentiles over successful calls."""
    volume = samples.groupBy(arm).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status") != "ok").alias("errors"),
        F.min_by(F.when(F.col("status") != "ok", F.col("status")),
                 F.when(F.col("status") != "ok", F.col("request_id"))).alias("first_error"))
    lat = order_statistics(samples.where("status = 'ok'"), [arm], "ms",
                           {"p50_ms": floor_rank(0.50), "p95_ms": floor_rank(0.95)})
    return (volume.join(lat.drop("n"), arm, "left")
            .select(arm, "requests", "errors", "first_error",
                    (F.col("errors") / F.greatest("requests", F.lit(1))).alias("error_rate"),
                    F.round("p50_ms", 1).alias("p50_ms"), F.round("p95_ms", 1).alias("p95_ms")))


def agreement(pairs: DataFrame, request: str, a: str, b: str, least: int = 1) -> DataFrame:
    """Mean rank correlation and mean top-3 overlap over requests both arms answered with ``least`` items or more."""
    each = rank_agreement(pairs, [request], a, b, 3).where(F.col("items") >= least)
    return each.agg(F.count(F.lit(1)).alias("pairs"), F.avg("spearman").alias("spearman_mean"),
                    F.avg("overlap").alias("top3_overlap_mean"))


def gate(summary: DataFrame, agree: DataFrame, champion: str, challenger: str,
         limits: dict[str, float] = CANARY, arm: str = "arm") -> DataFrame:
    """One row per check with the overall decision; an undefined correlation fails its check."""
    pick = lambda name, c: F.max(F.when(F.col(arm) == name, F.col(c)))
    s = summary.agg(pick(challenger, "error_rate").alias("err"), pick(challenger, "p95_ms").alias("p95"),
                    pick(champion, "p95_ms").alias("base"))
    one = s.withColumn("rho", agree.select("spearman_mean").scalar())
    rho_ok = F.col("rho").isNotNull() & ~F.isnan("rho") & (F.col("rho") >= limits["min_spearman"])
    ok = lambda c: F.coalesce(c, F.lit(False))
    checks = one.select(F.explode(F.array(
        F.struct(F.lit("error_rate").alias("check"), ok(F.col("err") <= limits["max_error_rate"]).alias("passed"),
                 F.col("err").alias("value")),
        F.struct(F.lit("p95_latency").alias("check"), ok(F.col("p95") <= F.col("base") * limits["max_p95_ratio"]).alias("passed"),
                 F.col("p95").alias("value")),
        F.struct(F.lit("rank_agreement").alias("check"), ok(rho_ok).alias("passed"),
                 F.col("rho").alias("value")))).alias("c")).select("c.*")
    verdict = checks.agg(F.bool_and("passed")).scalar()
    return checks.withColumn("decision", F.when(verdict, "PROMOTE").otherwise("ROLLBACK"))
