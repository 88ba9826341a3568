"""Column names as files hold them: with dots, spaces or back-ticks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column of exactly this name; ``F.col`` would read a dot as a field access."""
    return F.col(quoted(name))
