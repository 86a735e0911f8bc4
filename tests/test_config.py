import pytest

from fleetstream import FleetConfig
from fleetstream.config import FeatureScaling, duration_micros


def test_defaults():
    cfg = FleetConfig()
    assert (cfg.batch_interval, cfg.window_length, cfg.window_slide) == (
        "2 seconds", "6 seconds", "2 seconds",
    )
    assert (cfg.step_size, cfg.iterations, cfg.num_weights) == (0.1, 3, 7)


@pytest.mark.parametrize(
    "text, micros",
    [("2 seconds", 2_000_000), ("1 hour", 3_600_000_000), ("1 minute 30 seconds", 90_000_000),
     ("250 milliseconds", 250_000)],
)
def test_durations(text, micros):
    assert duration_micros(text) == micros


@pytest.mark.parametrize(
    "bad",
    [dict(window_length="5 seconds"), dict(window_slide="3 seconds"),
     dict(window_slide="8 seconds"), dict(parse_mode="lenient"), dict(truck_salts=0),
     dict(batch_interval="soon"), dict(history_mode="some"),
     dict(hot_share=0.0), dict(log_retention="a while"),
     dict(history_format="csv"), dict(scaling=FeatureScaling((0.0,), (1.0,)))],
)
def test_rejects(bad):
    with pytest.raises(ValueError):
        FleetConfig(**bad)


def test_weight_count():
    with pytest.raises(ValueError):
        FleetConfig().check_weights([1.0] * 6)
