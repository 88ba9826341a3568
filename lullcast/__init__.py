"""Intermittent-demand forecasting as Spark DataFrame operators."""

from lullcast.config import settings
from lullcast.schema import PanelSchema, resolve_roles

__all__ = ["PanelSchema", "resolve_roles", "settings"]
