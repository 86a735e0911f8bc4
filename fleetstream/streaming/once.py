"""A bounded input, processed to its last window through the batch operators.

A run is named by what it has admitted. It takes up the input files that no earlier run has
taken, and a run that was lost is finished, with the rows it had admitted, before the next
one begins. So a further run adds what is new and replaces nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetstream.config import FleetConfig
from fleetstream.operators.enrich import enrich_join
from fleetstream.operators.scoring import prequential_scores
from fleetstream.operators.stats import driver_window_stats
from fleetstream.schemas import ENRICHED_TRUCK_FIELDS, TRAFFIC_FIELDS, names
from fleetstream.sinks.outputs import append_history
from fleetstream.sources.store import Folder
from fleetstream.sources.weights import WeightsTable, initial_weights, train_history
from fleetstream.sources.workdir import shared_dir
from fleetstream.streaming.ingest import INPUTS, admitted, judged_lines

# Gets a run's rows and its name.
Sink = Callable[[DataFrame, str], None]


def _with_paths(lines: DataFrame) -> DataFrame:
    """The lines, with the ``path`` of the file each is in, if they are in files."""
    try:
        return lines.select("value", "arrival", F.col("_metadata.file_path").alias("path"))
    except AnalysisException:
        return lines.select("value", "arrival")


class _Runs:
    """What the runs before have taken, below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, path)

    def unread(self, lines: DataFrame, name: str) -> DataFrame:
        """The lines of files that no run has taken."""
        if "path" not in lines.columns or not self.folder.exists(f"taken/{name}"):
            return lines
        taken = self.spark.read.schema("path string, run string")
        # One row per file; its size decides how it is joined.
        return lines.join(
            taken.parquet(f"{self.path}/taken/{name}").select("path"), "path", "left_anti"
        )

    def take(self, rows: DataFrame, run: str) -> None:
        if "path" not in rows.columns:
            return
        for name in INPUTS:
            mine = rows.where((F.col("input") == name) & F.col("path").isNotNull())
            mine.select("path", F.lit(run).alias("run")).distinct().write.mode("append").parquet(
                f"{self.path}/taken/{name}"
            )


def _fingerprint(rows: DataFrame) -> str:
    """A name for a set of rows, whatever their order."""
    columns = [c for c in rows.columns if c != "path"]
    sums = rows.agg(
        F.count("*"), *[F.sum(F.xxhash64(F.lit(k), *columns).cast("decimal(20,0)")) for k in (0, 1)]
    ).first()
    return "once_" + "_".join(f"{int(x or 0) % 2**64:x}" for x in sums)


def run_once(
    spark: SparkSession,
    cfg: FleetConfig,
    truck_lines: DataFrame,
    traffic_lines: DataFrame,
    enriched_sinks: Sequence[Sink] = (),
    score_sinks: Sequence[Sink] = (),
    stats_sinks: Sequence[Sink] = (),
) -> None:
    """Process the lines that no earlier run has taken.

    No row is late here, and rows meet those of the same run. Training goes on from the
    newest batch; batches before it are not trained again, but scored, each with the newest
    weights from before it. Files are told by their path; an input that isn't files is
    told by its rows, and one that was processed before adds nothing. Without a log path
    nothing is remembered.
    """
    if cfg.parse_mode == "permissive" and not cfg.quarantine_path:
        raise ValueError("permissive parsing needs a quarantine_path")
    runs = _Runs(spark, cfg.log_path and f"{cfg.log_path}/runs" or shared_dir(spark, "runs"))
    last = runs.folder.newest("ledger")
    if last and not last["done"]:
        _finish(spark, cfg, runs, last, enriched_sinks, score_sinks, stats_sinks)
        last = dict(last, done=True)
    number = last["number"] + 1 if last else 0

    lines = {"truck": _with_paths(truck_lines), "traffic": _with_paths(traffic_lines)}
    lines = {name: runs.unread(df, name) for name, df in lines.items()}
    judged = judged_lines(lines["truck"], lines["traffic"], cfg.parse_mode)
    # Whether a row is from the future is decided here, once.
    rows = admitted(judged, cfg, int(time.time() * 1_000_000), {})
    stored = f"{runs.path}/rows"
    rows.write.mode("overwrite").parquet(stored)
    rows = spark.read.schema(rows.schema).parquet(stored)
    if rows.isEmpty():
        return
    run = {"number": number, "name": _fingerprint(rows), "done": False}
    if run["name"] in runs.folder.sizes("names"):
        return
    runs.folder.write(f"ledger/{number:012d}-a-open.json", run)
    _finish(spark, cfg, runs, run, enriched_sinks, score_sinks, stats_sinks)


def _finish(
    spark: SparkSession,
    cfg: FleetConfig,
    runs: _Runs,
    run: dict,
    enriched_sinks: Sequence[Sink],
    score_sinks: Sequence[Sink],
    stats_sinks: Sequence[Sink],
) -> None:
    """Deliver the stored rows of a run; what it has delivered already is not added twice."""
    rows = spark.read.parquet(f"{runs.path}/rows")
    good = rows.where(F.col("reason").isNull())
    truck = good.where(F.col("input") == "truck").select("arrival", *names(ENRICHED_TRUCK_FIELDS))
    traffic = good.where(F.col("input") == "traffic").select("arrival", *names(TRAFFIC_FIELDS))
    table = WeightsTable(spark, cfg.weights_path or shared_dir(spark, "weights"))
    train_history(truck, traffic, cfg, table, shared_dir(spark, "moments"))
    start, _ = initial_weights(spark, cfg)
    for df, sinks in (
        (enrich_join(truck, traffic, cfg), enriched_sinks),
        (prequential_scores(truck, traffic, table.read(), cfg, initial=start), score_sinks),
        (driver_window_stats(truck, traffic, cfg), stats_sinks),
    ):
        for sink in sinks:
            sink(df, run["name"])
    if cfg.quarantine_path:
        bad = rows.where(F.col("reason").isNotNull())
        for name in INPUTS:
            mine = bad.where(F.col("input") == name).select("value", "arrival", "reason")
            append_history(mine, f"{cfg.quarantine_path}/{name}", run["name"], "arrival")
    if not runs.folder.exists(f"names/{run['name']}"):
        runs.take(rows, run["name"])
        runs.folder.write(f"names/{run['name']}", {})
    runs.folder.write(f"ledger/{run['number']:012d}-b-done.json", dict(run, done=True))
