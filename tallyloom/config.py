"""Fixed values shared by the operators, and the defaults of a run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# What stands in for a missing feature.
FILL_AMOUNT = 0.0
FILL_RECENCY = -10.0
FILL_INTERPURCHASE = -10.0

# Caps and windows of the feature store.
AMOUNT_LIMIT = 10000
MAX_CLOSE_DELAY_DAYS = 4
ASP_CAP = 350
ROW_AMOUNT_CAP = 400
SAMPLE_SIZE = 300_000
MAX_EVENTS = 53

# Thresholds of the drift report.
DRIFT_SIGMAS = 2
DRIFT_CATEGORICAL = 0.05
OUTLIER_SIGMAS = 3

N_CLUSTERS = 4


@dataclass(frozen=True)
class Period:
    """Closed date interval in which orders must be closed."""

    start: dt.date
    end: dt.date


DEFAULT_PERIOD = Period(dt.date(1998, 1, 1), dt.date(1998, 12, 31))
