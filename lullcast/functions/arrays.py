"""A series' recent values as a bounded array: tails, pushes and window statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_n(values: Column, n: int) -> Column:
    """The last ``n`` elements, fewer if the array is shorter."""
    return F.slice(values, F.greatest(F.size(values) - F.lit(n - 1), F.lit(1)), n)


def pad_left(values: Column, n: int, fill: float = 0.0) -> Column:
    """The last ``n`` elements, filled up on the left."""
    gap = F.greatest(F.lit(n) - F.size(values), F.lit(0))
    return F.concat(F.array_repeat(F.lit(fill), gap), last_n(values, n))


def push(values: Column, new: Column, n: int) -> Column:
    """Append one element and keep the last ``n``."""
    return last_n(F.concat(values, F.array(new)), n)


def next_days_since_sale(previous: Column, y: Column) -> Column:
    """0 on a sale, else one more than before."""
    return F.when(y > 0, F.lit(0.0)).otherwise(previous + 1.0)


def from_end(values: Column, offset: int) -> Column:
    """The element ``offset`` places from the end (1 is the last), or null."""
    return F.try_element_at(values, F.lit(-offset))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def mean(values: Column) -> Column:
    """Mean of the non-null elements; null if there is none."""
    known = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, _total(known) / F.size(known))


def sample_std(values: Column) -> Column:
    """Two-pass sample deviation, so that a constant window gives exactly 0."""
    known = F.filter(values, lambda x: x.isNotNull())
    centre = _total(known) / F.size(known)
    squares = _total(F.transform(known, lambda x: (x - centre) * (x - centre)))
    return F.when(F.size(known) > 1, F.sqrt(squares / (F.size(known) - 1)))


def zero_count(values: Column) -> Column:
    """Elements that are 0, an unknown value counting as no sale."""
    return F.size(F.filter(values, lambda x: F.coalesce(x, F.lit(0.0)) == 0))
