"""Settings of the telemetry job."""

from __future__ import annotations

import re
from dataclasses import dataclass

from fleetstream.schemas import FEATURES

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(text: str) -> int:
    """Microseconds of a Spark duration such as ``'2 seconds'``."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?(?=\s|\d|$)", text.strip().lower())
    if not parts or any(unit not in _UNIT_MICROS for _, unit in parts):
        raise ValueError(f"not a duration: {text!r}")
    return sum(int(n) * _UNIT_MICROS[unit] for n, unit in parts)


@dataclass(frozen=True)
class FeatureScaling:
    """Per-feature ``(x - offset) / scale``; one entry per feature."""

    offsets: tuple[float, ...]
    scales: tuple[float, ...]

    def __post_init__(self):
        if len(self.offsets) != len(self.scales):
            raise ValueError("offsets and scales differ in length")
        if any(s == 0 for s in self.scales):
            raise ValueError("a scale is zero")


@dataclass(frozen=True)
class FleetConfig:
    # Logical clock. A window must consist of whole batches.
    batch_interval: str = "2 seconds"
    window_length: str = "6 seconds"
    window_slide: str = "2 seconds"
    # How far arrival times may run out of order across source partitions
    # before a row counts as late and is rejected. Zero would reject those of a lagging
    # partition.
    watermark_delay: str = "1 minute"

    # Training writes one small file per trigger, so it need not run every batch.
    training_trigger: str = "1 minute"

    # Grid of the stream joins: a hot (route, batch) group is cut into
    # truck_salts x traffic_salts tasks, at the price of traffic_salts copies of a
    # truck row and truck_salts copies of a reading. Batch joins leave it to AQE.
    truck_salts: int = 8
    traffic_salts: int = 2
    # A route is hot if a sketch of the admitted rows gives it this share of an input.
    hot_share: float = 0.1
    # For inputs that don't come from the ingest log: salt only these routes; None
    # salts all.
    salted_routes: tuple[int, ...] | None = None
    # Fixed for the life of a checkpoint; None keeps the session's value.
    stream_partitions: int | None = None

    kafka_brokers: str = "localhost:9092"
    truck_topic: str = "trucking"
    traffic_topic: str = "traffic"
    enriched_topic: str = "joined"
    stats_topic: str = "windowed"
    prediction_topic: str = "trucking_predictions"
    starting_offsets: str = "latest"
    # What one trigger may admit; None admits all there is.
    max_offsets_per_trigger: int | None = 5_000_000
    max_files_per_trigger: int | None = 1_000
    # Rows that arrive later than now by more than this are rejected, or fail the job
    # where lines are parsed strictly; one would make all others late.
    future_allowance: str | None = "1 hour"

    # Histories: typed "parquet" or rendered "text"; "append" keeps every trigger,
    # "latest" only the newest one that had rows.
    history_format: str = "parquet"
    history_mode: str = "append"
    enriched_path: str | None = None
    stats_path: str | None = None
    predictions_path: str | None = None
    weights_path: str | None = None
    # Rejected rows; by default they stay below the log.
    quarantine_path: str | None = None
    # Admitted rows, until all queries have read them and they are this old.
    log_path: str | None = None
    log_retention: str = "1 day"
    pretrained_path: str | None = None
    checkpoint_path: str | None = None
    # Tasks, and so files per day, that write one trigger's rows; None keeps all.
    sink_files: int | None = None

    features: tuple[str, ...] = FEATURES
    step_size: float = 0.1
    iterations: int = 3
    convergence_tol: float = 0.001
    scaling: FeatureScaling | None = None
    parse_mode: str = "strict"
    preview_rows: int = 10

    def __post_init__(self):
        batch = duration_micros(self.batch_interval)
        length = duration_micros(self.window_length)
        slide = duration_micros(self.window_slide)
        duration_micros(self.watermark_delay)
        duration_micros(self.log_retention)
        if self.future_allowance is not None:
            duration_micros(self.future_allowance)
        if batch <= 0 or length <= 0 or slide <= 0:
            raise ValueError("durations must be positive")
        if length % batch or slide % batch:
            raise ValueError(
                "window length and slide must be whole multiples of the batch interval"
            )
        if slide > length:
            raise ValueError("the slide must not exceed the window length")
        if self.truck_salts < 1 or self.traffic_salts < 1:
            raise ValueError("salts must be at least 1")
        if not 0 < self.hot_share <= 1:
            raise ValueError("the hot share must be above 0 and at most 1")
        if self.parse_mode not in ("strict", "permissive"):
            raise ValueError(f"unknown parse mode {self.parse_mode!r}")
        if self.history_format not in ("parquet", "text"):
            raise ValueError(f"unknown history format {self.history_format!r}")
        if self.history_mode not in ("append", "latest"):
            raise ValueError(f"unknown history mode {self.history_mode!r}")
        if self.scaling and len(self.scaling.scales) != len(self.features):
            raise ValueError("scaling does not match the feature list")

    @property
    def num_weights(self) -> int:
        return len(self.features)

    def check_weights(self, weights) -> list[float]:
        weights = [float(w) for w in weights]
        if len(weights) != self.num_weights:
            raise ValueError(
                f"{len(weights)} weights for {self.num_weights} features"
            )
        return weights
