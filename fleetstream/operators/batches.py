"""The logical batch: a tumbling window over arrival time.

Grouping rows by arrival interval rather than by scheduler trigger makes every
result reproducible and the same in batch and streaming mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetstream.config import FleetConfig, duration_micros


def with_watermark(df: DataFrame, cfg: FleetConfig) -> DataFrame:
    return df.withWatermark("arrival", cfg.watermark_delay) if df.isStreaming else df


def in_future(cfg: FleetConfig, now: int) -> Column:
    """Whether an arrival lies beyond the allowance for clocks that run ahead of ``now``,
    in microseconds. The caller decides once what "now" is."""
    if cfg.future_allowance is None:
        return F.lit(False)
    latest = F.timestamp_micros(F.lit(now + duration_micros(cfg.future_allowance)))
    return F.coalesce(F.col("arrival") > latest, F.lit(False))


def with_batch(df: DataFrame, cfg: FleetConfig) -> DataFrame:
    """Adds ``bw`` and drops ``arrival``, so one event-time column remains.

    A stream needs the window itself, which carries the watermark. A batch uses
    the window's start: eight fixed bytes hash and sort cheaper than a struct.
    """
    bucket = F.window("arrival", cfg.batch_interval)
    if df.isStreaming:
        return with_watermark(df, cfg).withColumn("bw", bucket).drop("arrival")
    return df.withColumn("bw", bucket.start).drop("arrival")


def batch_time(df: DataFrame) -> Column:
    """The time a batch stands for, usable in ``window()``."""
    return F.window_time("bw") if df.isStreaming else F.col("bw")


def batch_start(df: DataFrame) -> Column:
    return F.col("bw.start") if df.isStreaming else F.col("bw")
