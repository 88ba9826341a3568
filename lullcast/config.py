"""Default settings, and merging of a caller's overrides into them."""

from __future__ import annotations

from copy import deepcopy

# Defaults that decide results.
DEFAULTS: dict = {
    "runtime": {"seed": 42},
    "data": {
        "date_col_candidates": ["date", "ds"],
        "target_col_candidates": ["sales", "y", "target"],
        "id_col_candidates": ["store_id", "menu_id", "series_id", "영업장명", "메뉴명"],
        "min_context_days": 28,
        "min_positive_ratio": 0.01,
    },
    "features": {
        "fourier": {"weekly_K": 3, "yearly_K": 10},
        "lags": [1, 2, 7, 14, 28, 365],
        "rollings": [7, 14, 28],
        "short_history": "available",
        "intermittency": {
            "enable": True,
            "include_current": False,
            "pre_first_sale": "count",
        },
    },
    "model": {
        "classifier": {},
        "regressor": {"kind": "gbt", "tweedie_variance_power": 1.2},
    },
    "cv": {
        "horizon": 7,
        "init_train_ratio": 0.7,
        "tail_days": 28,
        "min_positive_samples": 10,
        "min_negative_samples": 10,
        "parallelism": 1,
    },
    "threshold": {"grid_start": 0.01, "grid_end": 0.99, "grid_step": 0.01},
}

# Column names of the Korean daily-sales layout.
KOREAN_COLUMNS: dict = {
    "data": {
        "date_col_candidates": ["영업일자"],
        "target_col_candidates": ["매출수량"],
        "id_col_candidates": ["영업장명_메뉴명"],
    }
}


def _merge(base: dict, extra: dict) -> dict:
    out = dict(base)
    for key, value in extra.items():
        nested = isinstance(value, dict) and isinstance(out.get(key), dict)
        out[key] = _merge(out[key], value) if nested else deepcopy(value)
    return out


def settings(*overrides: dict) -> dict:
    """The defaults with every override merged in, later ones winning."""
    out = deepcopy(DEFAULTS)
    for extra in overrides:
        out = _merge(out, extra)
    return out
