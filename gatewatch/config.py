"""Configuration values passed through every plan as frozen dataclasses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields, replace

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str | int) -> int:
    """``"5 minutes"`` -> 300. Whole seconds are passed through unchanged."""
    if isinstance(text, int):
        return text
    amount, unit = text.split()
    return int(amount) * _UNIT_SECONDS[unit.lower().rstrip("s")]


@dataclass(frozen=True)
class RiskConfig:
    """Thresholds and weights of the four risk rules."""

    # Fixed default values: they must equal the published rule set for scores to agree.
    lateral_movement_unique_hosts_1h: int = 10
    burst_login_event_count_1h: int = 50
    new_device_spike_unique_hosts_24h: int = 25
    weight_lateral_movement: int = 35
    weight_burst_login: int = 25
    weight_rare_host: int = 10
    weight_new_device_spike: int = 30

    # "new_device": a host is rare when the user has not used it before.
    # "popularity": a host is rare when it is among the day's least visited ones.
    rare_host_mode: str = "new_device"

    def __post_init__(self):
        if self.rare_host_mode not in ("new_device", "popularity"):
            raise ValueError(f"unknown rare_host_mode {self.rare_host_mode!r}")

    @classmethod
    def of(cls, overrides: Mapping | RiskConfig | None = None) -> RiskConfig:
        """Defaults with a partial mapping of overrides laid over them."""
        if overrides is None:
            return cls()
        if isinstance(overrides, RiskConfig):
            return overrides
        known = {f.name for f in fields(cls)}
        unknown = set(overrides) - known
        if unknown:
            raise ValueError(f"unknown risk settings: {sorted(unknown)}")
        return replace(cls(), **overrides)

    def as_dict(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k != "rare_host_mode"}


@dataclass(frozen=True)
class HopSpec:
    """One sliding window: its label, length and slide in seconds."""

    label: str
    duration: int
    slide: int

    @classmethod
    def of(cls, label: str, duration: str | int, slide: str | int | None = None) -> HopSpec:
        length = duration_seconds(duration)
        return cls(label, length, length if slide is None else duration_seconds(slide))

    @property
    def steps(self) -> int:
        """Number of slides in one window; every event falls into this many windows."""
        return self.duration // self.slide

    @property
    def aligned(self) -> bool:
        return self.duration % self.slide == 0


HOUR_HOP = HopSpec("1h", 3600, 300)
DAY_HOP = HopSpec("24h", 86400, 3600)


@dataclass(frozen=True)
class TablePaths:
    """Locations of the lake tables under one base path."""

    base: str

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}"

    @property
    def raw(self) -> str:
        return self.path("raw/auth_events")

    @property
    def features(self) -> str:
        return self.path("features/auth_user_features")

    @property
    def curated(self) -> str:
        return self.path("curated/auth_events_curated")

    @property
    def wide(self) -> str:
        return self.path("curated/auth_events_wide")

    @property
    def user_risk_hourly(self) -> str:
        return self.path("aggregates/user_risk_hourly")

    @property
    def host_risk_daily(self) -> str:
        return self.path("aggregates/host_risk_daily")

    @property
    def ledger(self) -> str:
        return self.path("state/raw_files")

    @property
    def user_behavior_hourly(self) -> str:
        return self.path("aggregates/user_behavior_hourly")

    @property
    def host_popularity_daily(self) -> str:
        return self.path("aggregates/host_popularity_daily")

    @property
    def seen_pairs(self) -> str:
        return self.path("state/pair_history")

    @property
    def landing(self) -> str:
        return self.path("landing/auth_events")

    @property
    def dead_letters(self) -> str:
        return self.path("dlq/auth_events")


@dataclass(frozen=True)
class StreamConfig:
    """Source, trigger and state settings of the streaming pipeline."""

    source_format: str = "text"
    source_options: Mapping[str, str] = field(default_factory=dict)
    source_path: str | None = None
    # Name of the payload column: "value" for files and Kafka, "data" for some connectors.
    payload_column: str = "value"
    payload_format: str = "json"
    # "latest" or "earliest"; only read by a query that starts without a checkpoint.
    start_from: str = "latest"
    checkpoint_location: str | None = None
    trigger_seconds: int = 30
    trigger_once: bool = False
    watermark: str = "5 minutes"
    # A day of the raw table is marked complete once the watermark has passed its end by this.
    commit_delay: str = "1 minute"
    # Shards of the first-seen state; fixed once a checkpoint exists.
    state_shards: int = 256
    # Shuffle partitions of stateful queries, fixed once a checkpoint exists; the
    # session's setting if None.
    state_partitions: int | None = None
    state_ttl: str | None = None
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    max_offsets_per_trigger: int | None = None


@dataclass(frozen=True)
class PipelineConfig:
    risk: RiskConfig = field(default_factory=RiskConfig)
    hour_hop: HopSpec = HOUR_HOP
    day_hop: HopSpec = DAY_HOP
    stream: StreamConfig = field(default_factory=StreamConfig)
    tables: TablePaths | None = None
