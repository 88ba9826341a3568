"""Per-series row windows: lags, rolling statistics, intermittency measures.

Offsets count rows, not days. All windows are ``schema.by_date()``, so operators
that follow each other share one exchange and one sort. On a panel with one row
per (series, date) a window partition holds at most one row per calendar day.

Each family of features is a list of layers, a layer being columns that read only
the columns before it. Families are applied side by side, so that their windows at
the same layer are evaluated together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lullcast.operators.chunks import (
    CHUNK,
    CHUNK_ROWS,
    LAST_SALE,
    LAST_STOP,
    NUMBER,
    from_day,
    in_chunks,
    out_of_chunks,
)
from lullcast.operators.cleaning import drop_null_keys
from lullcast.schema import PanelSchema

# Window lengths of the intermittency and report features.
ZERO_COUNT_ROWS = 7
INTERVAL_ROWS = 28
REPORT_LAGS = (1, 7, 14, 28)
REPORT_ROWS = 7

Layers = list[dict[str, Column]]


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _previous(schema: PanelSchema, rows: int) -> WindowSpec:
    """The ``rows`` rows before the current one, which itself is left out."""
    return schema.by_date().rowsBetween(-rows, -1)


def _so_far(schema: PanelSchema) -> WindowSpec:
    return schema.by_date().rowsBetween(Window.unboundedPreceding, 0)


def apply_layers(df: DataFrame, schema: PanelSchema, *families: Layers) -> DataFrame:
    """Add the families' columns; those whose name starts with ``_`` are interim."""
    out, interim = drop_null_keys(df, schema), set()
    for level in zip_longest(*families, fillvalue={}):
        columns = {name: c for layer in level for name, c in layer.items()}
        out = out.withColumns(columns)
        interim |= {name for name in columns if name.startswith("_")}
    return out.drop(*interim)


def with_layers(
    df: DataFrame,
    schema: PanelSchema,
    halo: int,
    make: Callable[[PanelSchema], Sequence[Layers]],
    chunk_rows: int | None = None,
    first=None,
) -> DataFrame:
    """Add the families that ``make`` gives, which look ``halo`` rows back, or to the start by
    what chunks carry. A panel without key columns is one series and is cut into chunks;
    with ``chunk_rows`` any panel is. With ``first`` only rows from that day on are made."""
    if chunk_rows is None and first is None and schema.keys:
        return apply_layers(df, schema, *make(schema))
    known = drop_null_keys(df, schema)
    if first is not None:
        rows, by_chunk = from_day(known, schema, halo, first)
    else:
        rows, by_chunk = in_chunks(known, schema, halo, chunk_rows or CHUNK_ROWS)
    return out_of_chunks(apply_layers(rows, by_chunk, *make(by_chunk)))


def _row_number(schema: PanelSchema) -> Column:
    return F.col(NUMBER) if CHUNK in schema.series else F.row_number().over(schema.by_date())


def _latest(schema: PanelSchema, number: Column, carried: str) -> Column:
    """The largest ``number`` so far in the series, ``carried`` being that before its chunk."""
    found = F.max(number).over(_so_far(schema))
    return F.greatest(found, F.col(carried)) if CHUNK in schema.series else found


def lag_layers(schema: PanelSchema, lags: Sequence[int]) -> Layers:
    y, w = F.col(schema.target), schema.by_date()
    return [{f"lag_{n}": _or_zero(F.lag(y, n).over(w)) for n in lags}]


def _merged(half: int, n: int) -> dict[str, Column]:
    """Statistics of ``n`` rows from those of the later and the earlier half."""
    late = {p: F.col(f"_{p}_{half}") for p in ("n", "sum", "m2", "min", "max")}
    early = {p: F.col(f"_{p}_{n}_early") for p in late}
    n_early, sum_early = F.coalesce(early["n"], F.lit(0)), _or_zero(early["sum"])
    rows = late["n"] + n_early
    gap = F.try_divide(late["sum"], late["n"]) - F.try_divide(sum_early, n_early)
    between = gap * gap * F.try_divide(late["n"] * n_early, rows)
    return {
        f"_n_{n}": rows,
        f"_sum_{n}": late["sum"] + sum_early,
        f"_m2_{n}": late["m2"] + _or_zero(early["m2"]) + _or_zero(between),
        f"_min_{n}": F.least(late["min"], early["min"]),
        f"_max_{n}": F.greatest(late["max"], early["max"]),
    }


def rolling_layers(schema: PanelSchema, windows: Sequence[int]) -> Layers:
    """Mean, sample deviation, minimum and maximum of the previous rows.

    A window twice as long as another is put together from that one and its value
    half a window ago: a sliding frame visits all its rows for every row. Squared
    deviations are merged about the halves' means, so nothing cancels, and a window
    of equal values has the deviation 0 exactly.
    """
    y, w = F.col(schema.target), schema.by_date()
    whole = set(windows)
    doubled = sorted(n for n in whole if n % 2 == 0 and n // 2 in whole)
    framed = sorted(whole - set(doubled))

    first, squares = {}, {}
    for n in framed:
        rows = _previous(schema, n)
        first |= {
            f"_n_{n}": F.count(y).over(rows),
            f"_sum_{n}": _or_zero(F.sum(y).over(rows)),
            f"_var_{n}": F.var_pop(y).over(rows),
            f"_min_{n}": F.min(y).over(rows),
            f"_max_{n}": F.max(y).over(rows),
        }
        squares[f"_m2_{n}"] = _or_zero(F.col(f"_var_{n}") * F.col(f"_n_{n}"))
    layers = [first, squares]
    for n in doubled:
        half = n // 2
        layers.append(
            {
                f"_{p}_{n}_early": F.lag(f"_{p}_{half}", half).over(w)
                for p in ("n", "sum", "m2", "min", "max")
            }
        )
        layers.append(_merged(half, n))

    last = {}
    for n in windows:
        count, m2 = F.col(f"_n_{n}"), F.col(f"_m2_{n}")
        varies = F.col(f"_min_{n}") < F.col(f"_max_{n}")
        last |= {
            f"roll_mean_{n}": _or_zero(F.try_divide(F.col(f"_sum_{n}"), count)),
            f"roll_std_{n}": _or_zero(F.sqrt(F.when(varies, F.try_divide(m2, count - 1)))),
            f"roll_min_{n}": _or_zero(F.col(f"_min_{n}")),
            f"roll_max_{n}": _or_zero(F.col(f"_max_{n}")),
        }
    return [*layers, last]


def since_sale_layers(schema: PanelSchema, name: str, pre_first_sale: str = "zero") -> Layers:
    """Rows since the latest positive row, the current row included.

    Before the first sale it is 0, or with ``pre_first_sale="count"`` the number
    of rows since the series began.
    """
    if pre_first_sale not in ("zero", "count"):
        raise ValueError(f"pre_first_sale must be 'zero' or 'count', not {pre_first_sale!r}")
    before = F.lit(0) if pre_first_sale == "count" else F.col("_rn")
    sale = F.when(F.col(schema.target) > 0, F.col("_rn"))
    return [
        {"_rn": _row_number(schema)},
        {},
        {"_sale_rn": _latest(schema, sale, LAST_SALE)},
        {name: (F.col("_rn") - F.coalesce("_sale_rn", before)).cast("double")},
    ]


def intermittency_layers(
    schema: PanelSchema, include_current: bool = True, pre_first_sale: str = "zero"
) -> Layers:
    no_sale = (_or_zero(F.col(schema.target)) == 0).cast("double")
    known = F.col("_since") if include_current else F.lag("_since", 1).over(schema.by_date())
    layers = since_sale_layers(schema, "_since", pre_first_sale)
    layers[0]["rolling_zero_count_7d"] = _or_zero(
        F.sum(no_sale).over(_previous(schema, ZERO_COUNT_ROWS))
    )
    mean_since = F.avg("_since").over(_previous(schema, INTERVAL_ROWS))
    return [
        *layers,
        {
            "days_since_last_sale": _or_zero(known),
            "avg_interdemand_interval": _or_zero(mean_since),
        },
    ]


def zero_run_layers(schema: PanelSchema, name: str) -> Layers:
    """Distance to the latest row that is not 0, which is where the run began."""
    is_zero = F.coalesce(F.col(schema.target) == 0, F.lit(False))
    return [
        {"_rn": _row_number(schema)},
        {"_stop_rn": _latest(schema, F.when(~is_zero, F.col("_rn")), LAST_STOP)},
        {name: (F.col("_rn") - F.coalesce("_stop_rn", F.lit(0))).cast("double")},
    ]


def lag_features(
    df: DataFrame, schema: PanelSchema, lags: Sequence[int], chunk_rows: int | None = None
) -> DataFrame:
    """The target ``n`` rows ago, 0 where there is none."""
    return with_layers(df, schema, max(lags, default=0), lambda s: [lag_layers(s, lags)], chunk_rows)


def rolling_features(
    df: DataFrame, schema: PanelSchema, windows: Sequence[int], chunk_rows: int | None = None
) -> DataFrame:
    """Mean, deviation, minimum and maximum of the rows before the current one."""
    halo = max(windows, default=0)
    return with_layers(df, schema, halo, lambda s: [rolling_layers(s, windows)], chunk_rows)


def lag_rolling_features(
    df: DataFrame,
    schema: PanelSchema,
    lags: Sequence[int],
    windows: Sequence[int],
    chunk_rows: int | None = None,
) -> DataFrame:
    halo = max([*lags, *windows], default=0)
    make = lambda s: [lag_layers(s, lags), rolling_layers(s, windows)]
    return with_layers(df, schema, halo, make, chunk_rows)


def days_since_sale(
    df: DataFrame,
    schema: PanelSchema,
    name: str = "days_since_last_sale",
    pre_first_sale: str = "zero",
    chunk_rows: int | None = None,
) -> DataFrame:
    def make(s: PanelSchema) -> list[Layers]:
        return [[*since_sale_layers(s, "_since", pre_first_sale), {name: F.col("_since")}]]

    return with_layers(df, schema, 0, make, chunk_rows)


def intermittency_features(
    df: DataFrame,
    schema: PanelSchema,
    include_current: bool = True,
    pre_first_sale: str = "zero",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Days since the last sale, zeros among the last 7 rows, and the mean
    days-since-sale of the last 28 rows.

    ``include_current=False`` gives the days since sale as known the day before,
    which does not reveal the current target.
    """
    make = lambda s: [intermittency_layers(s, include_current, pre_first_sale)]
    return with_layers(df, schema, INTERVAL_ROWS, make, chunk_rows)


def zero_run(
    df: DataFrame, schema: PanelSchema, name: str = "zero_run", chunk_rows: int | None = None
) -> DataFrame:
    """Length of the current run of zeros; 0 when the target is not 0."""
    return with_layers(df, schema, 0, lambda s: [zero_run_layers(s, name)], chunk_rows)


def report_features(
    df: DataFrame, schema: PanelSchema, chunk_rows: int | None = None
) -> DataFrame:
    """Lags, mean and sum of the previous 7 rows, and the zero run, per series."""

    def make(s: PanelSchema) -> list[Layers]:
        y, recent = F.col(s.target), _previous(s, REPORT_ROWS)
        sums = {"ma7": _or_zero(F.avg(y).over(recent)), "sum7": _or_zero(F.sum(y).over(recent))}
        return [lag_layers(s, REPORT_LAGS), [sums], zero_run_layers(s, "zero_run")]

    return with_layers(df, schema, max(REPORT_LAGS), make, chunk_rows)


def zero_fill(df: DataFrame) -> DataFrame:
    """Every null becomes 0: numbers 0, text the category ``0``."""
    return df.fillna(0).fillna("0")
