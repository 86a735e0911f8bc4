"""The whole job: every stream query wired to its sinks."""

from __future__ import annotations

import argparse
import dataclasses
import logging
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from fleetstream.config import FeatureScaling, FleetConfig, duration_micros
from fleetstream.operators.render import enriched_lines, prediction_lines, stats_lines
from fleetstream.sources.lines import file_lines, traffic_topic, truck_topic
from fleetstream.sources.weights import WeightsTable
from fleetstream.sources.workdir import shared_dir
from fleetstream.streaming import queries as q
from fleetstream.streaming.ingest import IngestLog, start_ingest
from fleetstream.streaming.once import run_once

log = logging.getLogger(__name__)


def start_all(
    spark: SparkSession,
    cfg: FleetConfig,
    truck_lines: DataFrame,
    traffic_lines: DataFrame,
    kafka: bool = True,
    preview: bool = True,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start ingestion, and statistics, training, and enrichment with scoring behind it.

    Lines are read and judged by the ingest query alone; the others are separate because a
    stream keeps its state per query, and read the log. ``spark`` should be a
    ``stream_session`` and the lines must be read through it. Without ``trigger`` the
    queries run on, for which a checkpoint path and a log path are needed; a bounded trigger
    admits what is there before the other queries begin. Permissive parsing needs a place
    for what it rejects.
    """
    if trigger is None and not (cfg.checkpoint_path and cfg.log_path):
        raise ValueError("a running job needs a checkpoint_path and a log_path")
    if cfg.parse_mode == "permissive" and not cfg.quarantine_path:
        raise ValueError("permissive parsing needs a quarantine_path")
    ingest = IngestLog(spark, cfg, cfg.log_path or shared_dir(spark, "log"))
    started = [start_ingest(ingest, truck_lines, traffic_lines, cfg, trigger)]
    if trigger is not None:
        started[0].awaitTermination()
    return started + start_readers(spark, cfg, ingest, kafka, preview, trigger)


def start_readers(
    spark: SparkSession,
    cfg: FleetConfig,
    ingest: IngestLog,
    kafka: bool = True,
    preview: bool = True,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start all queries that read the ingest log."""
    truck, traffic = ingest.inputs()
    table = WeightsTable(spark, cfg.weights_path or shared_dir(spark, "weights"))
    enriched_sinks, score_sinks, stats_sinks = _sinks(cfg, kafka, preview)
    if score_sinks:
        enriched_sinks.append(q.score_sink(table, cfg, score_sinks))
    started = [q.start_training(truck, traffic, cfg, table, trigger)]
    if enriched_sinks:
        started.append(q.start_enriched(*ingest.join_inputs(), cfg, enriched_sinks, trigger))
    if stats_sinks:
        started.append(q.start_stats(truck, traffic, cfg, stats_sinks, trigger))
    spark.streams.addListener(Watch(ingest, cfg, [query.name for query in started]))
    return started


class Watch(StreamingQueryListener):
    """Trims the log behind its readers, and reports rows that a reader left out."""

    def __init__(self, ingest: IngestLog, cfg: FleetConfig, readers: list[str]):
        self._ingest = ingest
        self._keep = duration_micros(cfg.log_retention) / 1e6
        self._began: dict[str, float | None] = dict.fromkeys(readers)
        self._trimmed = 0.0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        if late:
            # The ledger admits no such row; this would be an error of the log.
            log.error(
                "%s, trigger %s: %s admitted rows were left out",
                progress.name, progress.batchId, late,
            )
        if progress.name in self._began:
            began = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
            self._began[progress.name] = began.timestamp()
            self._trim()

    def _trim(self) -> None:
        times = list(self._began.values())
        now = time.time()
        # Listing the log is cheap beside a trigger, but not needed for each.
        if None in times or now - self._trimmed < self._keep / 10:
            return
        self._trimmed = now
        self._ingest.trim(min(times), self._keep)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def _sinks(cfg: FleetConfig, kafka: bool, preview: bool) -> tuple[list, list, list]:
    """Sinks of enriched rows, scores and statistics."""
    enriched_sinks, score_sinks, stats_sinks = [], [], []
    if preview:
        enriched_sinks.append(q.preview_sink(cfg.preview_rows))
        score_sinks.append(q.preview_sink(cfg.preview_rows))
    if kafka:
        enriched_sinks.append(q.kafka_sink(cfg, cfg.enriched_topic, enriched_lines))
        score_sinks.append(q.kafka_sink(cfg, cfg.prediction_topic, prediction_lines))
        stats_sinks.append(q.kafka_sink(cfg, cfg.stats_topic, stats_lines))
    for path, sinks, to_lines, time in (
        (cfg.enriched_path, enriched_sinks, enriched_lines, "bw"),
        (cfg.predictions_path, score_sinks, prediction_lines, "bw"),
        (cfg.stats_path, stats_sinks, stats_lines, "window_start"),
    ):
        if path:
            sinks.append(q.configured_history(cfg, path, to_lines, time))
    return enriched_sinks, score_sinks, stats_sinks


def _settings(argv) -> tuple[FleetConfig, argparse.Namespace]:
    parser = argparse.ArgumentParser(description="Run the telemetry stream job.")
    parser.add_argument("--truck-files", help="read truck lines from files, not Kafka")
    parser.add_argument("--traffic-files", help="read traffic lines from files")
    parser.add_argument("--no-kafka-out", action="store_true")
    parser.add_argument("--quiet", action="store_true", help="no console preview")
    parser.add_argument(
        "--once", action="store_true", help="process all that is there, to the last window"
    )
    kinds = {
        "int": int,
        "int | None": int,
        "float": float,
        "str": str,
        "str | None": str,
        "tuple[str, ...]": lambda text: tuple(text.split(",")),
        "tuple[int, ...] | None": lambda text: tuple(int(x) for x in text.split(",")),
        "FeatureScaling | None": lambda text: FeatureScaling(
            *(tuple(float(x) for x in part.split(",")) for part in text.split(";"))
        ),
    }
    fields = [f for f in dataclasses.fields(FleetConfig) if f.type in kinds]
    for f in fields:
        parser.add_argument("--" + f.name.replace("_", "-"), type=kinds[f.type])
    args = parser.parse_args(argv)
    given = {f.name: getattr(args, f.name) for f in fields}
    return FleetConfig(**{k: v for k, v in given.items() if v is not None}), args


def main(argv=None) -> None:
    cfg, args = _settings(argv)
    # The master and all resources come from spark-submit.
    spark = SparkSession.builder.appName("fleetstream").getOrCreate()
    session = q.stream_session(spark, cfg)
    live = not args.once
    limit = {"maxFilesPerTrigger": cfg.max_files_per_trigger} if live else {}
    limit = {k: v for k, v in limit.items() if v}

    def lines(path: str | None, topic) -> DataFrame:
        if path:
            return file_lines(session, path, streaming=live, **limit)
        return topic(session, cfg, streaming=live)

    truck = lines(args.truck_files, truck_topic)
    traffic = lines(args.traffic_files, traffic_topic)
    outputs = {"kafka": not args.no_kafka_out, "preview": not args.quiet}
    if args.once:
        run_once(session, cfg, truck, traffic, *_sinks(cfg, **outputs))
    else:
        start_all(session, cfg, truck, traffic, **outputs)
        session.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
