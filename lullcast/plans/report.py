"""The data report: is there anything to learn from this table?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lullcast.functions.calendar import report_calendar_parts
from lullcast.operators.cleaning import (
    keep_first,
    parse_dates_leniently,
    require_one_row_per_day,
)
from lullcast.operators.folds import calendar_split
from lullcast.operators.metrics import finite_report, split_report
from lullcast.operators.windows import report_features, zero_fill
from lullcast.schema import PanelSchema, canonical_date

# Fixed value: the features the report looks at, in their order.
REPORT_COLUMNS = (
    "dow", "dom", "month", "week", "is_month_start", "is_month_end",
    "zero_run", "lag_1", "lag_7", "lag_14", "lag_28", "ma7", "sum7",
)


def report_table(
    df: DataFrame,
    key: str,
    target: str,
    date: str = "ds",
    valid_days: int = 28,
    tie_break: Sequence[str] | None = None,
    is_panel: bool = False,
    last: Column | None = None,
) -> DataFrame:
    """``key, ds, target``, the report's features, and the ``split`` of each row.

    With ``tie_break`` only the first row per (key, date) is looked at, as in
    training. Without it there must be only one: else a key's windows would have no
    bound on their rows. That is checked, unless ``is_panel`` states it. ``last`` is the
    table's last date, if a smaller table tells it.
    """
    named = canonical_date(df, key, target, date)
    parsed = parse_dates_leniently(named, date)
    schema = PanelSchema(date, target, (key,))
    if tie_break is not None:
        parsed = keep_first(parsed, schema, tie_break)
    elif not is_panel:
        require_one_row_per_day(parsed, schema)
    featured = zero_fill(report_features(parsed, schema))
    dated = featured.withColumns(report_calendar_parts(F.col(date)))
    columns = [key, date, target, *REPORT_COLUMNS]
    if last is None:
        last = parsed.select(F.max(date)).scalar()
    return calendar_split(dated.select(*columns), date, valid_days, last=last)


def data_report(table: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Per split: size, target variance, weekdays and months; and the finite check."""
    return split_report(table, target), finite_report(table, [*REPORT_COLUMNS, key], target)


def require_variance(split: DataFrame) -> None:
    """Raise if the training target does not vary."""
    found = split.filter(F.col("split") == "train").first()
    if found is None or not found["y_var"] or found["y_var"] != found["y_var"]:
        raise ValueError("the training target has no variance, so no split can gain anything")
