"""The running queries. Each is the batch operator on a streaming input."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetstream.config import FleetConfig
from fleetstream.operators.batches import batch_start
from fleetstream.operators.enrich import (
    COPIES,
    by_level,
    enrich_join,
    every_row,
    latest_traffic,
    repeat_rows,
)
from fleetstream.operators.scoring import predict_versioned
from fleetstream.operators.stats import driver_window_stats
from fleetstream.operators.training import batch_moments
from fleetstream.sinks.outputs import (
    append_history,
    print_rows,
    write_kafka,
    write_latest,
)
from fleetstream.sources.weights import WeightsTable, initial_weights
from fleetstream.sources.workdir import shared_dir

# A sink gets one trigger's rows and the trigger's name.
Sink = Callable[[DataFrame, str], None]


def stream_session(spark: SparkSession, cfg: FleetConfig) -> SparkSession:
    """A session of its own, so that stream settings leave the caller's alone."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    if cfg.stream_partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(cfg.stream_partitions))
    # State beyond memory lives on local disk; commits upload only the changes. All stores
    # of an executor share one limit of memory, however many they are.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session


def start(
    df: DataFrame,
    name: str,
    cfg: FleetConfig,
    sinks: Sequence[Sink],
    trigger: dict | None,
    mode: str = "append",
    reuse: bool = False,
) -> StreamingQuery:
    started: Future = Future()

    def each(batch: DataFrame, number: int) -> None:
        epoch = f"{started.result().id}-{number}"
        if len(sinks) == 1 and not reuse:
            sinks[0](batch, epoch)
            return
        # Without this every sink would run the stateful plan again.
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, epoch)
        finally:
            batch.unpersist()

    # Without a configured path nothing finds the checkpoint again, but it is at
    # least where every executor can reach it.
    checkpoint = cfg.checkpoint_path or shared_dir(df.sparkSession, "checkpoint")
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .foreachBatch(each)
    )
    trigger = trigger or {"processingTime": cfg.batch_interval}
    query = writer.trigger(**trigger).start()
    started.set_result(query)
    return query


def enriched_stream(truck: DataFrame, traffic: DataFrame, cfg: FleetConfig) -> DataFrame:
    """Joined rows; where readings come with their levels, the sinks here take these apart."""
    joined = enrich_join(truck, traffic, cfg)
    return joined.withColumn("bw", batch_start(joined))


def _read_whole(batch: DataFrame, added: bool) -> None:
    """A replayed trigger that adds nothing must still go through its state."""
    if not added:
        batch.write.format("noop").mode("overwrite").save()


def history_sink(path: str, time: str = "bw", **options) -> Sink:
    return lambda batch, epoch: _read_whole(
        batch, append_history(batch, path, epoch, time, **options)
    )


def configured_history(cfg: FleetConfig, path: str, to_lines, time: str = "bw") -> Sink:
    """The history in the format and mode the config asks for."""
    text = cfg.history_format == "text"

    def sink(batch: DataFrame, epoch: str) -> None:
        if cfg.history_mode == "latest":
            rows = _lines(batch, to_lines) if text else batch
            _read_whole(batch, write_latest(rows, path, cfg.history_format, epoch))
            return
        rows = _lines(batch, to_lines, (time,)) if text else batch
        format, files = cfg.history_format, cfg.sink_files
        _read_whole(batch, append_history(rows, path, epoch, time, format, files))

    return sink


def _lines(batch: DataFrame, to_lines, carry: tuple[str, ...] = ()) -> DataFrame:
    """One line per row; equal rows are rendered once."""
    rows = by_level(batch)
    if COPIES not in rows.columns:
        return to_lines(rows, carry=carry)
    return repeat_rows(to_lines(rows, carry=(*carry, COPIES)))


def kafka_sink(cfg: FleetConfig, topic: str, to_lines) -> Sink:
    return lambda batch, epoch: write_kafka(_lines(batch, to_lines), cfg, topic)


def preview_sink(rows: int) -> Sink:
    return lambda batch, epoch: print_rows(every_row(batch), rows)


# Batches whose versions are broadcast; a version is some 200 bytes, so this is a few
# megabytes. A trigger that holds more shuffles them.
_FEW_BATCHES = 20_000


def score_batch(
    batch: DataFrame,
    table: WeightsTable,
    cfg: FleetConfig,
    asked: DataFrame | None = None,
) -> DataFrame | None:
    """Scores of one trigger's enriched rows, or None if it has no rows.

    Every batch is scored with the newest weights from before it that training has stored
    so far; ``weights_bw`` tells which. A trigger's rows share a few logical batches, so a
    shuffle by batch would end in a few tasks; the versions are broadcast instead, if the
    trigger does not span too many. ``asked`` may hold the distinct ``bw`` of the rows.
    """
    asked = batch.select("bw").distinct() if asked is None else asked
    ends = asked.agg(
        F.unix_micros(F.min("bw")).alias("first"),
        F.unix_micros(F.max("bw")).alias("last"),
        F.count("bw").alias("n"),
    ).first()
    if ends["first"] is None:
        return None
    few = ends["n"] <= _FEW_BATCHES
    start, _ = initial_weights(table.spark, cfg)
    versions = table.between(ends["first"], ends["last"] + 1)
    return predict_versioned(batch, versions, cfg, start, few=few, asked=asked)


def score_sink(
    table: WeightsTable,
    cfg: FleetConfig,
    sinks: Sequence[Sink],
    batches: DataFrame | None = None,
) -> Sink:
    """Scores each trigger's rows. ``batches`` may hold the distinct ``bw`` of all that will
    come, if that is known; without it the join runs once more for those of the trigger."""

    def sink(batch: DataFrame, epoch: str) -> None:
        # A row per logical batch is kept, not the rows: these can be many times the input.
        asked = batch.select("bw").distinct() if batches is None else batches
        asked = asked.persist()
        try:
            scored = score_batch(batch, table, cfg, asked)
            if scored is None:
                return
            if len(sinks) == 1:
                sinks[0](scored, epoch)
                return
            # One set of versions for all outputs, though training goes on meanwhile.
            scored.persist()
            try:
                for out in sinks:
                    out(scored, epoch)
            finally:
                scored.unpersist()
        finally:
            asked.unpersist()

    return sink


def start_stats(
    truck: DataFrame,
    traffic: DataFrame,
    cfg: FleetConfig,
    sinks: Sequence[Sink],
    trigger: dict | None = None,
) -> StreamingQuery:
    stats = driver_window_stats(truck, traffic, cfg)
    return start(stats, "driver_stats", cfg, sinks, trigger)


def start_training(
    truck: DataFrame,
    traffic: DataFrame,
    cfg: FleetConfig,
    table: WeightsTable,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Trains on each logical batch once, after the watermark has closed it."""
    moments = batch_moments(truck, traffic, cfg)
    step = lambda batch, _: table.train(batch, cfg)
    trigger = trigger or {"processingTime": cfg.training_trigger}
    return start(moments, "training", cfg, [step], trigger, reuse=True)


def start_enriched(
    truck: DataFrame,
    traffic: DataFrame,
    cfg: FleetConfig,
    sinks: Sequence[Sink],
    trigger: dict | None = None,
) -> StreamingQuery:
    joined = enriched_stream(truck, traffic, cfg)
    return start(joined, "enriched", cfg, sinks, trigger)


def start_latest_traffic(
    traffic: DataFrame,
    cfg: FleetConfig,
    sinks: Sequence[Sink],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Changed routes per trigger; the state is one row per route. Rows of the log that
    only close windows are no readings."""
    if "pos" in traffic.columns:
        traffic = traffic.where("pos >= 0")
    return start(latest_traffic(traffic), "latest_traffic", cfg, sinks, trigger, "update")
