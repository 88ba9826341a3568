"""The recursive forecast: every step feeds on the steps before it."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lullcast.functions import arrays
from lullcast.functions.calendar import calendar_parts, fourier_terms
from lullcast.operators.hurdle import hurdle
from lullcast.operators.state import (
    StateSpec,
    interval_columns,
    series_state,
    window_columns,
)
from lullcast.operators.windows import INTERVAL_ROWS, ZERO_COUNT_ROWS
from lullcast.schema import PanelSchema
from lullcast.workspace import materialize

# Steps after which the growing plan is cut by writing the state to a table.
STEPS_PER_PLAN = 14


class Scorer(Protocol):
    """Anything that adds the chance ``p`` and quantity ``q`` to a feature table.

    ``inputs`` names the features it reads; no others are computed for it.
    """

    inputs: frozenset[str]

    def score(self, features: DataFrame) -> DataFrame: ...


class RuleScorer:
    """Chance: share of sale days among the last 7. Quantity: their mean."""

    inputs = frozenset(["rolling_zero_count_7d", "roll_mean_7"])

    def score(self, features: DataFrame) -> DataFrame:
        days = F.lit(float(ZERO_COUNT_ROWS))
        return features.withColumns(
            {"p": (days - F.col("rolling_zero_count_7d")) / days, "q": F.col("roll_mean_7")}
        )


class ZeroScorer:
    """No sale, for data on which no model can be fitted."""

    inputs = frozenset()

    def score(self, features: DataFrame) -> DataFrame:
        return features.withColumns({"p": F.lit(0.0), "q": F.lit(0.0)})


def future_calendar(
    df: DataFrame, schema: PanelSchema, horizon: int, origin: Column | None, cfg: dict
) -> DataFrame:
    """Calendar and Fourier features of the ``horizon`` days after each distinct
    last date of a series: ``(last_ds, step, ds, …)``.

    Without ``origin`` the Fourier terms count from each first future day.
    """
    lasts = df.groupBy(*schema.partition()).agg(F.max(schema.date).alias("last_ds"))
    steps = lasts.select("last_ds").distinct().select(
        "last_ds", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    )
    days = steps.withColumn("ds", F.date_add("last_ds", F.col("step")))
    start = F.date_add("last_ds", 1) if origin is None else origin
    return days.withColumns(future_columns(F.col("ds"), start, cfg))


def future_columns(ds: Column, origin, cfg: dict) -> dict[str, Column]:
    f = cfg["features"]["fourier"]
    return {**calendar_parts(ds), **fourier_terms(ds, origin, f["weekly_K"], f["yearly_K"])}


def attach_future_calendar(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Look calendar features up by (last_ds, step); Spark broadcasts the calendar
    if its size allows."""
    return rows.join(calendar, ["last_ds", "step"])


def _lag(step: int, n: int) -> Column:
    """Value ``n`` days before step ``step``: an earlier forecast or history."""
    if n < step:
        return F.col(f"yhat_{step - n}")
    return F.coalesce(arrays.from_end(F.col("hist"), n - step + 1), F.lit(0.0))


def _shared_features(scorer: Scorer, spec: StateSpec, cfg: dict, origin) -> dict[str, Column]:
    """The features whose expression is the same at every step."""
    features = window_columns(F.col("recent"), spec.windows)
    if spec.intermittency:
        features |= interval_columns(F.col("recent"), F.col("ring"))
    start = F.date_add("last_ds", 1) if origin is None else origin
    features |= future_columns(F.col("next_ds"), start, cfg)
    return {name: c for name, c in features.items() if name in scorer.inputs}


def _step(
    state: DataFrame,
    kept: list[str],
    h: int,
    shared: dict[str, Column],
    scorer: Scorer,
    threshold: float,
    spec: StateSpec,
) -> DataFrame:
    recent, ring, yhat = F.col("recent"), F.col("ring"), F.col(f"yhat_{h}")
    lags = {f"lag_{n}": _lag(h, n) for n in spec.lags if f"lag_{n}" in scorer.inputs}
    scored = scorer.score(state.withColumns({**lags, **shared})).select(
        *kept,
        F.col("p").cast("double").alias(f"p_{h}"),
        F.col("q").cast("double").alias(f"q_{h}"),
        hurdle(F.col("p"), F.col("q"), threshold).alias(f"yhat_{h}"),
    )
    since = F.coalesce(arrays.from_end(ring, 1), F.lit(0.0))
    return scored.withColumns(
        {
            "recent": arrays.push(recent, yhat, spec.window_rows),
            "ring": arrays.push(ring, arrays.next_days_since_sale(since, yhat), INTERVAL_ROWS),
            "next_ds": F.date_add("next_ds", 1),
        }
    )


def forecast_from_state(
    state: DataFrame,
    schema: PanelSchema,
    scorer: Scorer,
    threshold: float,
    cfg: dict,
    spec: StateSpec | None = None,
    origin=None,
) -> DataFrame:
    """``keys, last_ds`` and ``p_h, q_h, yhat_h`` for every step ``h``.

    Each step is a projection of the one-row-per-series state, so the steps add no
    shuffle. The history array stays as it is: a lag reads it, or an earlier step's
    column; only the short ``recent`` and ``ring`` arrays move.
    """
    spec = spec or StateSpec.from_settings(cfg)
    horizon = cfg["cv"]["horizon"]
    current = state.withColumns(
        {
            "recent": arrays.last_n(F.col("hist"), spec.window_rows),
            "next_ds": F.date_add("last_ds", 1),
        }
    )
    kept = [*schema.keys, "last_ds", "next_ds", "hist", "recent", "ring"]
    shared = _shared_features(scorer, spec, cfg, origin)
    for h in range(1, horizon + 1):
        current = _step(current, kept, h, shared, scorer, threshold, spec)
        kept += [f"p_{h}", f"q_{h}", f"yhat_{h}"]
        if h % STEPS_PER_PLAN == 0 and h < horizon:
            current = materialize(current, "forecast-steps")
    return current.drop("next_ds", "hist", "recent", "ring")


def recursive_forecast(
    panel: DataFrame,
    schema: PanelSchema,
    scorer: Scorer,
    threshold: float,
    cfg: dict,
    spec: StateSpec | None = None,
    origin=None,
) -> DataFrame:
    """Forecast every series from the day after its own last day."""
    spec = spec or StateSpec.from_settings(cfg)
    state = series_state(panel, schema, spec)
    return forecast_from_state(state, schema, scorer, threshold, cfg, spec, origin)


def forecast_long(forecast: DataFrame, schema: PanelSchema, horizon: int) -> DataFrame:
    """``keys, step, ds, yhat, p, q``, one row per series and step."""
    steps = F.array(
        *[
            F.struct(
                F.lit(h).alias("step"),
                F.date_add("last_ds", h).alias("ds"),
                F.col(f"yhat_{h}").alias("yhat"),
                F.col(f"p_{h}").alias("p"),
                F.col(f"q_{h}").alias("q"),
            )
            for h in range(1, horizon + 1)
        ]
    )
    return forecast.select(*schema.keys, F.inline(steps))


def forecast_wide(forecast: DataFrame, schema: PanelSchema, horizon: int) -> DataFrame:
    """``keys, D1 … DH``."""
    return forecast.select(
        *schema.keys, *[F.col(f"yhat_{h}").alias(f"D{h}") for h in range(1, horizon + 1)]
    )
