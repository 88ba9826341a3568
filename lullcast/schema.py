"""Which columns of a table play the date, target and series roles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lullcast.functions.names import column

# Id of a panel without key columns, and the name fragments that
# mark a date column.
SINGLE_SERIES = "__single__"
DATE_NAME_PARTS = ("date", "ds", "일자", "날짜", "기준일자")


@dataclass(frozen=True)
class PanelSchema:
    """Column roles of a panel: one row per (batch, series, date)."""

    date: str
    target: str
    series: tuple[str, ...] = ()
    batch: str | None = None

    @property
    def keys(self) -> list[str]:
        return ([self.batch] if self.batch else []) + list(self.series)

    def partition(self) -> list[Column]:
        """Columns whose values delimit one series."""
        return [column(k) for k in self.keys] or [F.lit(SINGLE_SERIES)]

    def by_date(self) -> WindowSpec:
        """The one window every per-series operator shares, so that a chain of
        operators needs one exchange and one sort."""
        return Window.partitionBy(*self.partition()).orderBy(column(self.date))

    def with_series(self, *series: str) -> PanelSchema:
        return replace(self, series=tuple(series))

    def with_batch(self, batch: str | None) -> PanelSchema:
        return replace(self, batch=batch)


def resolve_roles(columns: Sequence[str], cfg: dict) -> PanelSchema:
    """Find the role columns by explicit name, else by candidate list.

    Every present key column is taken; the first present date and target are.
    """
    data = cfg.get("data", {})
    present = set(columns)

    def pick(role: str) -> str | None:
        names = [data.get(f"{role}_col"), *data.get(f"{role}_col_candidates", [])]
        return next((n for n in names if n in present), None)

    date, target = pick("date"), pick("target")
    lacking = [role for role, name in (("date", date), ("target", target)) if name is None]
    if lacking:
        raise ValueError(
            f"no column found for {' and '.join(lacking)}; available: {sorted(present)}"
        )
    wanted = data["id_cols"] if "id_cols" in data else data.get("id_col_candidates", [])
    return PanelSchema(date, target, tuple(c for c in wanted if c in present))


def find_date_column(columns: Sequence[str], preferred: str | None = None) -> str:
    """``preferred`` if present, else the first column that is named like a date."""
    if preferred in columns:
        return preferred
    for name in columns:
        if any(part in name.lower() for part in DATE_NAME_PARTS):
            return name
    raise ValueError(f"no date column among {list(columns)}")


def canonical_date(df: DataFrame, key: str, target: str, preferred: str = "ds") -> DataFrame:
    """Detect the date column and rename it to ``preferred``."""
    absent = [c for c in (key, target) if c not in df.columns]
    if absent:
        raise ValueError(f"key/target columns not found: {absent}; available: {df.columns}")
    return df.withColumnRenamed(find_date_column(df.columns, preferred), preferred)
