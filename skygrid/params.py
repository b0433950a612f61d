"""Every constant of the engine, in one place.

The numbers of the interpolation method are those of Thornton, Running & White (1997), Thornton &
Running (1999), De Caceres et al. (2018) and FAO-56 (Allen et al. 1998), kept here so that they can
be corrected without touching the operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Calendar rules of the daily run.
RAW_DAYS_BACK = 385
LAST_DAYS_BACK = 5
INTERPOLATION_DAYS_BACK = 370
WINDOW_DAYS = 17
STUDY_WINDOW_DAYS = 16

# A feed serves a date only when it is older than this many days.
SERVICE_LAG_DAYS = {"aemet": 4, "meteocat": 0}
SERVICES = ("aemet", "meteocat", "meteogalicia", "ria")
MANDATORY_SERVICE = "aemet"

# Geography.
PENINSULA_BOX = (-15.0, 5.0, 35.0, 44.4)
STATION_BUFFER_M = 99000.0
PARTITION_ROWS = 15
PARTITION_COLS = 14
EXCLUDED_PROVINCES = ("Ceuta", "Melilla", "Palmas, Las", "Las Palmas", "Santa Cruz de Tenerife")

# Small grid partitions and the partition that takes them in.
PARTITION_MERGES = {
    1: 15, 5: 19, 6: 20, 7: 21, 8: 22, 23: 37, 24: 38, 25: 39, 40: 54, 41: 55, 43: 29, 59: 60,
    69: 55, 81: 80, 95: 94, 100: 101, 114: 115, 121: 122, 128: 129, 142: 143, 150: 136, 156: 157,
    170: 171, 177: 163, 185: 186, 190: 176, 199: 200, 201: 187,
    98: 138, 110: 138, 111: 138, 112: 138, 123: 138, 124: 138, 125: 138, 137: 138,
}

# Layout of the published tables.
INTERPOLATED_ROWS_PER_GROUP = 5000
INTERPOLATED_ROWS_PER_FILE = 1000000
CV_ROWS_PER_GROUP = 2109
BITMAP_ROWS_PER_GROUP = 11

# Map images.
BITMAP_SCALE = 1000
BITMAP_BLOCK = 4
BITMAP_PALETTE_NAME = "ag_GrnYl"
BITMAP_RAMP = (
    "#FF0D50", "#FB7C82", "#FEABAC", "#FFD7D7", "#F2EFF2", "#9AAABA", "#4B8AA1", "#007490", "#006584",
)
BITMAP_UNREVERSED = (
    "MeanRelativeHumidity", "MinRelativeHumidity", "MaxRelativeHumidity", "Precipitation", "PET",
)
BITMAP_MISSING = "#FFFFFF00"

CALIBRATED = ("MinTemperature", "MaxTemperature", "DewTemperature", "PrecipitationEvent", "PrecipitationAmount")
SHORT_NAMES = {
    "MinTemperature": "tmin", "MaxTemperature": "tmax", "DewTemperature": "tdew",
    "PrecipitationEvent": "prec_event", "PrecipitationAmount": "prec_amount",
}


def _grid(ns, alphas):
    return tuple((float(n), float(a)) for n in ns for a in alphas)


# Smoothing parameters searched every day.
DAILY_GRID = {
    "MinTemperature": _grid(range(20, 161, 20), range(10, 51, 10)),
    "MaxTemperature": _grid(range(20, 161, 20), range(10, 51, 10)),
    "DewTemperature": _grid((10, 30, 130, 150), [0.5 + 10 * k for k in range(7)]),
    "PrecipitationEvent": _grid((10, 20, 30), range(20, 101, 20)),
    "PrecipitationAmount": _grid((10, 50, 120, 150), (1, 10, 20, 30)),
}
# The calibration study searches one wider grid for every variable.
STUDY_GRID = {
    v: _grid(range(10, 151, 10), [0.5 + 10 * k for k in range(11)]) for v in CALIBRATED
}


@dataclass(frozen=True)
class InterpolationParams:
    """Numbers of the interpolation method; station counts and shapes are per variable."""

    initial_radius_m: float = 140000.0
    radius_passes: int = 3
    smoothing: dict[str, tuple[float, float]] = field(default_factory=lambda: {
        "MinTemperature": (30.0, 3.0),
        "MaxTemperature": (30.0, 3.0),
        "DewTemperature": (30.0, 3.0),
        "PrecipitationEvent": (5.0, 5.0),
        "PrecipitationAmount": (20.0, 5.0),
        "Wind": (5.0, 3.0),
    })
    regression_min_stations: int = 5
    regression_min_variance_km2: float = 0.01
    wet_threshold_mm: float = 0.0
    event_cut: float = 0.5
    amount_max_f: float = 0.6
    default_wind_ms: float = 2.0
    # Radiation: clear-sky transmittance, vapour-pressure term, cloud response, wet-day factor.
    tau_clear: float = 0.870
    vapour_slope_per_kpa: float = -0.061
    cloud_b0: float = 0.031
    cloud_b1: float = 0.201
    cloud_b2: float = 0.185
    cloud_c: float = 1.5
    wet_day_factor: float = 0.75
    solar_constant: float = 0.0820
    albedo: float = 0.23


DEFAULTS = InterpolationParams()
