"""The driver contract: every query has a name, runs lazily and agrees with its SQL."""

import duckdb
import pytest

import __spark_entry__ as E
import check

SAMPLE = ["viewer_features_ts", "recent_behavior_ts", "title_features_ts", "rail_features", "position_propensity",
          "pit_training_set", "pit_composite_lookup", "label_weights", "eligible_all", "candidates_top_n",
          "rank_within_viewer", "rail_fill", "ndcg_mrr", "auc_rank_sum", "canary_gate", "upsert_merge",
          "change_feed_diff", "request_mix", "price_interval_join", "nearest_rank_percentiles", "declared_operators",
          "declared_rolling", "stream_session_drained"]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_registry():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) > 120 and set(SAMPLE) <= set(o)


def test_flagship(spark):
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, con, sf, name):
    got = E.queries()[name](spark, sf).toPandas()
    note = check.compare(got, con.execute(E.oracle_sql()[name]).df())
    assert note == "" or note.startswith("~"), note
