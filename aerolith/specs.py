"""The metric dictionary: families, columns, units and inputs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

# Metric names, units and aggregates of the products.
COMPLETE, PARTIAL, UNAVAILABLE = "COMPLETE", "PARTIAL", "UNAVAILABLE"
CALM, OUTSIDE_RH = "UNDEFINED_CALM_MEAN", "OUTSIDE_SUPPORTED_RH_DOMAIN"


@dataclass(frozen=True)
class Metric:
    family: str
    column: str
    unit: str
    inputs: tuple[str, ...]
    daily: tuple[str, ...]

    def daily_columns(self) -> list[tuple[str, str]]:
        """``(column, aggregate)``; a sum keeps the hourly name."""
        return [(self.column if a == "sum" else f"{self.column}_{a.upper()}", a) for a in self.daily]


METRICS = (
    Metric("temperature", "TEMPERATURE_2M_C", "degC", ("t2m",), ("mean", "min", "max")),
    Metric("dewpoint", "DEWPOINT_2M_C", "degC", ("d2m",), ("mean",)),
    Metric("relative_humidity", "RELATIVE_HUMIDITY_2M_PCT", "percent", ("t2m", "d2m"), ("mean",)),
    Metric("wind", "U_WIND_10M_MS", "m/s", ("u10",), ("mean",)),
    Metric("wind", "V_WIND_10M_MS", "m/s", ("v10",), ("mean",)),
    Metric("wind", "WIND_SPEED_10M_MS", "m/s", ("u10", "v10"), ("mean", "max")),
    Metric("wind", "WIND_DIRECTION_10M_DEG_FROM", "degrees", ("u10", "v10"), ("mean_vector",)),
    Metric("cloud_cover", "TOTAL_CLOUD_COVER_PCT", "percent", ("tcc",), ("mean",)),
    Metric("pressure", "MEAN_SEA_LEVEL_PRESSURE_HPA", "hPa", ("msl",), ("mean", "min")),
    Metric("precipitation", "PRECIPITATION_MM", "mm", ("tp",), ("sum",)),
)
FAMILIES = tuple(dict.fromkeys(m.family for m in METRICS))
#: Accumulated inputs: the value stamped t + 1 h belongs to the hour that starts at t.
ACCUMULATED = frozenset(["tp", "ssrd", "fdir"])
UNITS = {"t2m": "K", "d2m": "K", "u10": "m s**-1", "v10": "m s**-1", "msl": "Pa", "tcc": "(0 - 1)", "tp": "m",
         "ssrd": "J m**-2", "fdir": "J m**-2"}


def selected(families: Sequence[str] | None = None) -> list[Metric]:
    """Metrics of the families in canonical order; None means all."""
    if families is None:
        return list(METRICS)
    if isinstance(families, str) or not families:
        raise ValueError("families: a list with at least one name is needed")
    unknown = [f for f in families if f not in FAMILIES]
    if unknown or len(set(families)) != len(families):
        raise ValueError(f"families: unknown or repeated names in {list(families)}")
    return [m for m in METRICS if m.family in families]


def inputs_of(metrics: Sequence[Metric]) -> list[str]:
    """The native fields that the metrics read, in the order of the unit table."""
    used = {i for m in metrics for i in m.inputs}
    return [i for i in UNITS if i in used]
