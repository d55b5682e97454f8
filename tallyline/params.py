"""Plain parameter objects.  Small, hand-edited configuration only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = str | dt.date | dt.datetime

# Fixed values shared with stored rows.
DETECTOR = "cluster_cost"
ALERT_SIGNALS = ("WARNING", "CRITICAL")
EVENT_TYPES = ("message_sent", "message_suppressed", "message_failed")
OPEN_END = "9999-01-01 00:00:00"


def as_of_ts(as_of: AsOf) -> Column:
    """The reference time as a timestamp literal (a date means its midnight)."""
    text = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def as_of_date(as_of: AsOf) -> Column:
    return as_of_ts(as_of).cast("date")


@dataclass(frozen=True)
class Thresholds:
    """Signal tiers: dollars per day and log-space z-scores, all strict ``>``."""

    budget: float = 5000.0
    z_warning: float = 2.0
    z_critical: float = 3.0


@dataclass(frozen=True)
class SuppressionWindows:
    warning_hours: int = 24
    critical_hours: int = 4

    def hours(self) -> dict[str, int]:
        return {"WARNING": self.warning_hours, "CRITICAL": self.critical_hours}


@dataclass(frozen=True)
class Routing:
    """``channel_only`` or ``dm_with_fallback`` (optionally copied to the channel)."""

    mode: str
    channel: str
    tee_to_channel: bool = False


@dataclass(frozen=True)
class ExclusionRules:
    """Hand-written exclusion lists; a handful of entries each."""

    ids: Sequence[str] = ()
    name_patterns: Sequence[str] = ()
    creators: Sequence[str] = ()


@dataclass(frozen=True)
class LensRule:
    """Which usage rows belong to an asset type, and which column names the asset."""

    asset_type: str
    product: str
    id_column: str
    billing_product: str | None = None


# The four asset lenses.
LENS_RULES = (
    LensRule("cluster", "COMPUTE", "cluster_id", "ALL_PURPOSE"),
    LensRule("job", "WORKFLOWS", "job_id"),
    LensRule("serving_endpoint", "MODEL_SERVING", "endpoint_name", "MODEL_SERVING"),
    LensRule("warehouse", "SQL", "warehouse_id", "SQL"),
)
