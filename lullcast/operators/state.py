"""One bounded row per series: what is needed to compute tomorrow's features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lullcast.functions import arrays
from lullcast.operators.windows import INTERVAL_ROWS, ZERO_COUNT_ROWS, days_since_sale
from lullcast.schema import PanelSchema


@dataclass(frozen=True)
class StateSpec:
    """Which lags and windows the state has to serve, and how it treats a series
    shorter than they are: ``available`` rows only, or ``zero_pad``."""

    lags: tuple[int, ...] = (1, 2, 7, 14, 28, 365)
    windows: tuple[int, ...] = (7, 14, 28)
    intermittency: bool = True
    short_history: str = "available"

    @classmethod
    def from_settings(cls, cfg: dict) -> StateSpec:
        f = cfg["features"]
        return cls(
            tuple(f["lags"]),
            tuple(f["rollings"]),
            f.get("intermittency", {}).get("enable", True),
            f.get("short_history", "available"),
        )

    @property
    def tail_rows(self) -> int:
        return max([*self.lags, *self.windows, ZERO_COUNT_ROWS]) + 1

    @property
    def window_rows(self) -> int:
        return max([*self.windows, ZERO_COUNT_ROWS])

    @property
    def pads(self) -> bool:
        return self.short_history == "zero_pad"


def tail_rows(df: DataFrame, schema: PanelSchema, n: int, name: str = "_rn") -> DataFrame:
    """The last ``n`` rows per series with their row number from its start."""
    w = schema.by_date()
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = df.withColumns(
        {name: F.row_number().over(w), "_n": F.count("*").over(whole)}
    )
    return numbered.filter(F.col(name) > F.col("_n") - n).drop("_n")


def series_state(df: DataFrame, schema: PanelSchema, spec: StateSpec) -> DataFrame:
    """Per series: ``last_ds``, ``n_obs``, the values ``hist`` of its last rows and
    the days-since-sale ``ring`` of its last 28 rows.

    Rows are cut to the tail before they are collected, so an array is as long as the
    longest lag or window at most; the grouping reuses the window's partitioning.
    """
    since = days_since_sale(df, schema, "since", pre_first_sale="count")
    tail = tail_rows(since, schema, max(spec.tail_rows, INTERVAL_ROWS))
    keys = schema.keys
    grouped = tail.groupBy(*keys).agg(
        F.max(schema.date).alias("last_ds"),
        F.max("_rn").alias("n_obs"),
        F.sort_array(
            F.collect_list(F.struct("_rn", F.col(schema.target).alias("y"), "since"))
        ).alias("_rows"),
    )
    values = F.transform("_rows", lambda r: r["y"].cast("double"))
    hist = arrays.last_n(values, spec.tail_rows)
    ring = arrays.last_n(F.transform("_rows", lambda r: r["since"]), INTERVAL_ROWS)
    if spec.pads:
        hist, ring = arrays.pad_left(hist, spec.tail_rows), arrays.pad_left(ring, INTERVAL_ROWS)
    return grouped.select(*keys, "last_ds", "n_obs", hist.alias("hist"), ring.alias("ring"))


def window_columns(recent: Column, windows: Sequence[int]) -> dict[str, Column]:
    """Rolling statistics over the last values of an array."""
    out = {}
    for n in windows:
        values = arrays.last_n(recent, n)
        out[f"roll_mean_{n}"] = F.coalesce(arrays.mean(values), F.lit(0.0))
        out[f"roll_std_{n}"] = F.coalesce(arrays.sample_std(values), F.lit(0.0))
        out[f"roll_min_{n}"] = F.coalesce(F.array_min(values), F.lit(0.0))
        out[f"roll_max_{n}"] = F.coalesce(F.array_max(values), F.lit(0.0))
    return out


def interval_columns(recent: Column, ring: Column) -> dict[str, Column]:
    """Intermittency features as known after the last value of the arrays."""
    zeros = arrays.zero_count(arrays.last_n(recent, ZERO_COUNT_ROWS)).cast("double")
    return {
        "days_since_last_sale": F.coalesce(arrays.from_end(ring, 1), F.lit(0.0)),
        "rolling_zero_count_7d": zeros,
        "avg_interdemand_interval": F.coalesce(arrays.mean(ring), F.lit(0.0)),
    }


def step_features(state: DataFrame, spec: StateSpec) -> DataFrame:
    """Features of the day after ``last_ds``, from the state alone."""
    hist = F.col("hist")
    lags = {
        f"lag_{n}": F.coalesce(arrays.from_end(hist, n), F.lit(0.0)) for n in spec.lags
    }
    more = interval_columns(hist, F.col("ring")) if spec.intermittency else {}
    return state.withColumns({**lags, **window_columns(hist, spec.windows), **more})


def push_observation(state: DataFrame, y: str | Column, spec: StateSpec) -> DataFrame:
    """The state one day later, after the value ``y`` was seen."""
    new = y if isinstance(y, Column) else F.col(y)
    since = arrays.next_days_since_sale(
        F.coalesce(arrays.from_end(F.col("ring"), 1), F.lit(0.0)), new
    )
    return state.withColumns(
        {
            "hist": arrays.push(F.col("hist"), new, spec.tail_rows),
            "ring": arrays.push(F.col("ring"), since, INTERVAL_ROWS),
            "last_ds": F.date_add("last_ds", 1),
            "n_obs": F.col("n_obs") + 1,
        }
    )


def update_state(
    state: DataFrame, new_rows: DataFrame, schema: PanelSchema, spec: StateSpec
) -> DataFrame:
    """Move each series on by its new row, of which there may be one per series.

    A row that is not newer than the state's last day changes nothing, and neither
    does the absence of one.
    """
    fresh = new_rows.select(
        *schema.keys,
        F.col(schema.date).alias("_new_ds"),
        F.col(schema.target).cast("double").alias("_new_y"),
    )
    joined = state.join(fresh, schema.keys, "left")
    is_newer = F.coalesce(F.col("_new_ds") > F.col("last_ds"), F.lit(False))
    moves = {c: F.col(c).alias(f"_old_{c}") for c in ("hist", "ring", "last_ds", "n_obs")}
    both = joined.select("*", is_newer.alias("_moves"), *moves.values())
    moved = push_observation(both, "_new_y", spec).withColumn("last_ds", F.col("_new_ds"))
    return moved.withColumns(
        {c: F.when(F.col("_moves"), F.col(c)).otherwise(F.col(f"_old_{c}")) for c in moves}
    ).select(state.columns)


def update_features(
    state: DataFrame, new_rows: DataFrame, schema: PanelSchema, spec: StateSpec
) -> DataFrame:
    """The state after ``new_rows`` and the next day's features from it."""
    return step_features(update_state(state, new_rows, schema, spec), spec)
