"""Column -> Column functions: built-in expressions only, no Python UDF."""

from aerolap.functions.codes import (
    band_rank,
    cancel_cause,
    delay_band,
    flight_band,
    month_name,
    normalise_code,
    ratio,
    route_key,
)
from aerolap.functions.time import elapsed, hhmm_to_minutes, timezone_ok, wrap_24h

__all__ = [
    "band_rank",
    "cancel_cause",
    "delay_band",
    "elapsed",
    "flight_band",
    "hhmm_to_minutes",
    "month_name",
    "normalise_code",
    "ratio",
    "route_key",
    "timezone_ok",
    "wrap_24h",
]
