"""Request-time feature functions as native column expressions.

Each takes and returns columns, treats every null input explicitly and stays inside code
generation. ``bind`` maps named inputs to request or looked-up columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import (CLICK_CUTOFF_DAYS, CLICK_DECAY_DAYS, DEVICE_FIT, DEVICE_FIT_DEFAULT,
                         GENRES, SESSION_CUTOFF_MINUTES, SESSION_DECAY_MINUTES)


def _or(c: Column, value) -> Column:
    return F.coalesce(c.cast("double"), F.lit(float(value)))


def affinity_match(affinity: list[Column], genre: list[Column]) -> Column:
    """Dot product of viewer affinities and the title's genre flags."""
    total = F.lit(0.0)
    for a, g in zip(affinity, genre):
        total = total + _or(a, 0) * _or(g, 0)
    return total


def affinity_x_popularity(affinity: list[Column], genre: list[Column], popularity: Column) -> Column:
    return affinity_match(affinity, genre) * (F.lit(0.5) + _or(popularity, 0))


def hour_affinity(hour_of_day: Column, typical_hour: Column, concentration: Column) -> Column:
    """Closeness of the request hour to the viewer's usual hour on the 24 h circle."""
    h, t, c = _or(hour_of_day, 0), _or(typical_hour, -1), _or(concentration, 0)
    raw = F.pmod(F.abs(h - t), F.lit(24.0))
    d = F.least(raw, F.lit(24.0) - raw)
    return F.when(t < 0, F.lit(0.0)).otherwise((1 - d / 12.0) * (0.5 + 0.5 * c))


def _decay(request_s: Column, past_s: Column, unit: float, cutoff: float, scale: float) -> Column:
    r = F.coalesce(request_s.cast("bigint"), F.lit(0).cast("bigint"))
    p = F.coalesce(past_s.cast("bigint"), F.lit(0).cast("bigint"))
    age = F.greatest(F.lit(0.0), (r - p) / F.lit(unit))
    dead = (r == 0) | (p == 0) | (age > cutoff)
    return F.when(dead, F.lit(0.0)).otherwise(F.exp(-age / F.lit(scale)))


def session_decay(request_s: Column, last_event_s: Column) -> Column:
    """exp(-minutes/30) since the last watch event; zero past 24 h or when unknown."""
    return _decay(request_s, last_event_s, 60.0, SESSION_CUTOFF_MINUTES, SESSION_DECAY_MINUTES)


def rail_click_recency(request_s: Column, last_click_s: Column) -> Column:
    """exp(-days/7.2) since the viewer last engaged with the rail; zero past 120 days."""
    return _decay(request_s, last_click_s, 86400.0, CLICK_CUTOFF_DAYS, CLICK_DECAY_DAYS)


def rail_taste_match(affinity: list[Column], genre_index: Column) -> Column:
    """Affinity for the rail's genre; the mean affinity when the rail has none."""
    a = [_or(x, 0) for x in affinity]
    i = F.coalesce(genre_index.cast("bigint"), F.lit(-1).cast("bigint"))
    total = a[0]
    for x in a[1:]:
        total = total + x
    return F.when(i.between(0, len(a) - 1), F.element_at(F.array(*a), (i + 1).cast("int"))
                  ).otherwise(total / len(a))


def rail_taste_match_v2(affinity: list[Column]) -> Column:
    """Second version beside the first: mean of the known affinities, zero when none is."""
    total, n = F.lit(0.0), F.lit(0)
    for x in affinity:
        total = total + _or(x, 0)
        n = n + x.isNotNull().cast("int")
    return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def device_rail_fit(device: Column, type_index: Column) -> Column:
    """Fixed device x rail-type table; unknown device reads the web row, bad index 0.5."""
    row = lambda d: F.array(*[F.lit(v) for v in DEVICE_FIT[d]])
    fit = row("web")
    for d in ("tv", "console", "mobile"):
        fit = F.when(device == d, row(d)).otherwise(fit)
    i = F.coalesce(type_index.cast("bigint"), F.lit(-1).cast("bigint"))
    n = len(DEVICE_FIT["web"])
    return F.when(i.between(0, n - 1), F.element_at(fit, (i + 1).cast("int"))
                  ).otherwise(F.lit(DEVICE_FIT_DEFAULT))


@dataclass(frozen=True)
class FeatureFunction:
    """A named output computed from bound inputs after the lookups."""
    output: str
    fn: Callable[..., Column]
    inputs: dict[str, str | list[str]]

    def column(self) -> Column:
        arg = lambda v: [F.col(c) for c in v] if isinstance(v, list) else F.col(v)
        return self.fn(**{k: arg(v) for k, v in self.inputs.items()}).alias(self.output)


def apply_functions(df: DataFrame, fns: list[FeatureFunction]) -> DataFrame:
    missing = sorted({c for f in fns for v in f.inputs.values()
                      for c in (v if isinstance(v, list) else [v])} - set(df.columns))
    if missing:
        raise ValueError(f"feature functions need columns {missing}")
    return df.withColumns({f.output: f.column() for f in fns})


AFFINITY = [f"genre_affinity_{g}" for g in GENRES]
GENRE_FLAGS = [f"genre_{g}" for g in GENRES]

SHARED = [
    FeatureFunction("hour_affinity", hour_affinity,
                    {"hour_of_day": "hour_of_day", "typical_hour": "typical_watch_hour",
                     "concentration": "hour_concentration"}),
    FeatureFunction("session_decay", session_decay,
                    {"request_s": "request_epoch_s", "last_event_s": "last_event_epoch_s"}),
]
TITLE_FUNCTIONS = [
    FeatureFunction("affinity_match", affinity_match,
                    {"affinity": AFFINITY, "genre": GENRE_FLAGS}),
    FeatureFunction("affinity_x_popularity", affinity_x_popularity,
                    {"affinity": AFFINITY, "genre": GENRE_FLAGS, "popularity": "popularity_30d"}),
] + SHARED
RAIL_FUNCTIONS = [
    FeatureFunction("rail_taste_match", rail_taste_match,
                    {"affinity": AFFINITY, "genre_index": "rail_genre_idx"}),
    FeatureFunction("rail_click_recency", rail_click_recency,
                    {"request_s": "request_epoch_s", "last_click_s": "vr_last_click_epoch_s"}),
    FeatureFunction("device_rail_fit", device_rail_fit,
                    {"device": "device", "type_index": "rail_type_idx"}),
] + SHARED
