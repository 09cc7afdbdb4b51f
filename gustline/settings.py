"""One frozen settings object shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

SENSORS = ("wind_speed", "temperature", "power", "frequency")
FLAGS = ("is_observed", "is_synthetic", "is_imputed", "is_simulated")
FARM_SERIES = "farm_total_power"

# Horizon name -> steps of the sampling interval.
HORIZONS = {"10min": 1, "30min": 3, "1hour": 6, "6hour": 36, "24hour": 144}

# Limits used when clipping readings.
CLIP_LIMITS = {
    "wind_speed": (0.0, 60.0),
    "temperature": (-10.0, 55.0),
    "power": (0.0, 2200.0),
    "frequency": (47.0, 53.0),
}

# Wider limits used when only reporting suspicious readings.
REPORT_LIMITS = {
    "wind_speed": (0.0, 60.0),
    "temperature": (-30.0, 55.0),
    "power": (0.0, 2500.0),
    "frequency": (45.0, 55.0),
}

# Units by sensor.
UNITS = {"wind_speed": "m/s", "temperature": "°C", "power": "kW", "frequency": "Hz"}
REPORT_UNITS = {"wind_speed": "m/s", "temperature": "degC", "power": "kW", "frequency": "Hz"}


@dataclass(frozen=True)
class FarmSettings:
    interval_minutes: int = 10
    rated_kw: float = 2200.0
    n_turbines: int = 12
    max_fill_slots: int = 12
    lags: tuple[int, ...] = (1, 2, 3, 6, 12, 144)
    windows: tuple[int, ...] = (6, 18, 36, 144)
    ramp_pct_per_min: float = 0.5
    train_ratio: float = 0.70
    val_ratio: float = 0.15
    report_date: str = "2026-08-01"
    top_features: int = 150
    seed: int = 42

    @property
    def farm_rated_kw(self) -> float:
        return self.rated_kw * self.n_turbines


DEFAULTS = FarmSettings()
