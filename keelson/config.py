"""Thresholds and region boxes shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# Thresholds, groups and status names every result depends on.
YEARS = (2015, 2016, 2017, 2018, 2019)
TRACK_GAP_SECONDS = 7200
SOG_CUTOFF = 30.0
SPEED_CUTOFF_KNOTS = 40.0
SLOW_SPEED_KNOTS = 0.01
GRID_STEP_SECONDS = 300
HISTORY_STEPS = 37
FUTURE_STEPS = 35
TIME_GAPS_SECONDS = (900, 1800)
VESSEL_GROUPS = (
    "cargo",
    "passenger",
    "fishing",
    "tug tow",
    "tanker",
    "pleasure craft or sailing",
)
STATUSES = ("under way sailing", "under way using engine", "undefined")
CURRENT_VARIABLES = ("water_u", "water_v")
CATEGORICAL_COLUMNS = ("vessel_group", "destination_cluster")
CLUSTER_SAMPLE_SEED = "4148846"


@dataclass(frozen=True)
class Box:
    """A latitude/longitude rectangle."""

    lat_1: float
    lat_2: float
    lon_1: float
    lon_2: float


@dataclass(frozen=True)
class Region:
    """A study area: its box, the stride of training windows, clustering parameters."""

    name: str
    box: Box
    window_movement: int
    eps_km: float
    min_pts: int
    depth: tuple[float, float] = (0.0, 0.0)


# The three study areas.
REGIONS = {
    "florida_gulf": Region("florida_gulf", Box(26.0, 29.0, -85.5, -81.5), 15 * 60, 5.0, 50),
    "california_coast": Region("california_coast", Box(33.4, 36.4, -122.0, -118.5), 15 * 60, 3.0, 50),
    "new_york": Region("new_york", Box(39.5, 41.5, -74.5, -71.5), 60 * 60, 3.0, 50),
}


@dataclass(frozen=True)
class Config:
    """Every threshold an operator reads; the defaults are the production values."""

    track_gap: int = TRACK_GAP_SECONDS
    sog_cutoff: float = SOG_CUTOFF
    speed_cutoff: float = SPEED_CUTOFF_KNOTS
    slow_speed: float = SLOW_SPEED_KNOTS
    step: int = GRID_STEP_SECONDS
    history: int = HISTORY_STEPS
    future: int = FUTURE_STEPS
    min_track: int = (HISTORY_STEPS + FUTURE_STEPS) * GRID_STEP_SECONDS
    time_gaps: tuple[int, ...] = TIME_GAPS_SECONDS
    years: tuple[int, ...] = YEARS
    vessel_groups: tuple[str, ...] = VESSEL_GROUPS
    statuses: tuple[str, ...] = STATUSES
    test_fraction: float = 0.2
    validation_fraction: float = 0.2
    seed: str = "0"
    window_movement: int = 15 * 60
    # Rows of one vessel-day beyond which that day is cut into finer pieces.
    hot_rows: int = 1_000_000

    @property
    def window_length(self) -> int:
        return self.history + self.future + 1

    @property
    def train_stride(self) -> int:
        return int(self.window_movement / self.step)
