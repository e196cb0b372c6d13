import math

from pyspark.sql import functions as F

from tidemark.constants import RAIL_COLUMN_ROLES
from tidemark.functions import request as R
from tidemark.plans import training as T


def value(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


N = lambda t="double": F.lit(None).cast(t)


def test_every_null_input_is_answered(spark):
    none8 = [N()] * 8
    assert value(spark, R.affinity_match(none8, none8)) == 0.0
    assert value(spark, R.affinity_x_popularity(none8, none8, N())) == 0.0
    assert value(spark, R.hour_affinity(N(), N(), N())) == 0.0
    assert value(spark, R.session_decay(N("bigint"), N("bigint"))) == 0.0
    assert value(spark, R.rail_click_recency(N("bigint"), N())) == 0.0
    assert value(spark, R.rail_taste_match(none8, N("bigint"))) == 0.0
    assert value(spark, R.rail_taste_match_v2(none8)) == 0.0
    assert value(spark, R.device_rail_fit(N("string"), N("bigint"))) == 0.5


def test_rules(spark):
    a = [F.lit(x / 10) for x in range(8)]
    assert value(spark, R.rail_taste_match(a, F.lit(3))) == 0.3
    assert abs(value(spark, R.rail_taste_match(a, F.lit(8))) - 0.35) < 1e-12
    assert abs(value(spark, R.rail_taste_match(a, F.lit(-1))) - 0.35) < 1e-12
    assert abs(value(spark, R.rail_taste_match_v2([N(), F.lit(0.4), F.lit(0.2)])) - 0.3) < 1e-12
    assert value(spark, R.device_rail_fit(F.lit("toaster"), F.lit(3))) == 0.7
    assert value(spark, R.device_rail_fit(F.lit("tv"), F.lit(7))) == 0.5
    assert abs(value(spark, R.hour_affinity(F.lit(23), F.lit(1.0), F.lit(1.0))) - 10 / 12) < 1e-12
    assert abs(value(spark, R.session_decay(F.lit(7200), F.lit(3600))) - math.exp(-2)) < 1e-12
    assert value(spark, R.session_decay(F.lit(100 + 86460), F.lit(100))) == 0.0
    assert value(spark, R.session_decay(F.lit(0), F.lit(5))) == 0.0
    assert value(spark, R.rail_click_recency(F.lit(86400 * 121 + 5), F.lit(5.0))) == 0.0


def test_column_checks(spark):
    num, cat = RAIL_COLUMN_ROLES["numeric"], RAIL_COLUMN_ROLES["categorical"]
    assert len(num) == 44 and len(cat) == 3 and "rail_position" not in num
    have = spark.createDataFrame([], ", ".join(f"{c} double" for c in num[1:] + cat + ["surprise"]))
    got = {r.column_name: (r.role, r.status) for r in T.column_status(have, RAIL_COLUMN_ROLES).collect()}
    assert got[num[0]] == ("numeric", "missing") and got["surprise"] == (None, "unclaimed")
    assert got[cat[0]] == ("categorical", "ok") and got["rail_position"] == ("neither", "missing")


def test_reattach_guards(spark):
    import pytest
    f = spark.createDataFrame([(1,), (2,)], "k int")
    side = lambda d: spark.createDataFrame(d, "k int, w double")
    assert T.reattach(f, side([(1, 1.0), (2, 2.0)]), ["k"]).count() == 2
    with pytest.raises(Exception, match="not unique"):
        T.reattach(f, side([(1, 1.0), (1, 3.0), (2, 2.0)]), ["k"]).collect()
    with pytest.raises(Exception, match="no match"):
        T.reattach(f, side([(1, 1.0)]), ["k"]).collect()
