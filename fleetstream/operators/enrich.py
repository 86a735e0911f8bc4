"""Truck events meet the traffic readings of their route and logical batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetstream.config import FleetConfig
from fleetstream.operators.batches import with_batch
from fleetstream.schemas import ENRICHED_FIELDS, ENRICHED_TRUCK_FIELDS, names


#: For how many equal rows a row of ``enriched_groups`` stands.
COPIES = "_copies"
#: What a truck row has met, as pairs of ``congestion_level`` and ``_copies``.
LEVELS = "_levels"
#: Truck rows of one route and batch, as records.
TRUCKS = "_trucks"
#: Records in one array, about.
_PACK = 256
#: Copies that are made from one array.
_MOST_COPIES = 65_536
#: Neighbouring levels that share an array, so that none grows with the readings.
_SPAN = 64


def is_hot(df: DataFrame, cfg: FleetConfig) -> Column:
    """Whether a row's group is spread over the grid. Rows of the ingest log say so
    themselves, both inputs alike; of others the config may name the routes."""
    if "hot" in df.columns:
        return F.coalesce(F.col("hot"), F.lit(False))
    if cfg.salted_routes is None:
        return F.lit(True)
    return F.coalesce(F.col("route_id").isin(*cfg.salted_routes), F.lit(False))


def _hot_or_first(hot: Column, slot: Column) -> Column:
    return F.when(hot, slot).otherwise(F.lit(0))


def own_slot(df: DataFrame, hot: Column, slots: int) -> Column:
    """A row's own slot, from what is stored of it, so that a retried task deals every
    row as before. Rows of the ingest log have a position; equal rows of other inputs
    share a slot."""
    place = ["epoch", "pos"] if {"epoch", "pos"} <= set(df.columns) else df.columns
    return _hot_or_first(hot, F.pmod(F.xxhash64(*place), F.lit(slots)).cast("int"))


def every_slot(hot: Column, slots: int) -> Column:
    return F.explode(F.sequence(F.lit(0), _hot_or_first(hot, F.lit(slots - 1))))


def key_slot(hot: Column, column: str, slots: int) -> Column:
    """The slot of a row that is unique in ``column`` within its group."""
    return _hot_or_first(hot, F.pmod(F.xxhash64(column), F.lit(slots)).cast("int"))


def _splits_hot_groups(df: DataFrame) -> bool:
    """Whether the session splits skewed join partitions at run time."""
    conf = df.sparkSession.conf
    return not df.isStreaming and all(
        conf.get(key).lower() == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def default_salts(cfg: FleetConfig, *inputs: DataFrame) -> tuple[int, int]:
    """The config's grid, unless AQE takes care of hot groups."""
    if all(_splits_hot_groups(df) for df in inputs):
        return 1, 1
    return cfg.truck_salts, cfg.traffic_salts


def reading_of(df: DataFrame) -> str:
    """What rows hold of readings: one's level, or the levels of several."""
    return LEVELS if LEVELS in df.columns else "congestion_level"


def _join_sides(
    truck: DataFrame,
    traffic: DataFrame,
    cfg: FleetConfig,
    salts: tuple[int, int] | None,
    extra: tuple[str, ...],
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of the join and its keys.

    In batch mode Catalyst picks the strategy from the sides' sizes, and AQE
    splits a hot (route, batch) group on either side. A stream has no AQE, so
    there, or where AQE is off, a hot group is spread over a grid of tasks: a row
    has one slot of its own side and a copy for every slot of the other, so each
    pair meets in exactly one cell. Rows of cold groups are not copied. ``salts``
    overrides the grid.
    """
    truck_slots, traffic_slots = salts or default_salts(cfg, truck, traffic)
    fields = ["route_id", TRUCKS] if TRUCKS in truck.columns else names(ENRICHED_TRUCK_FIELDS)
    left = truck.select("arrival", *fields, *extra)
    right = traffic.select("arrival", "route_id", reading_of(traffic))
    keys = ["route_id", "bw"]
    if truck_slots * traffic_slots > 1:
        hot = is_hot(truck, cfg)
        left = truck.select(
            *left.columns,
            own_slot(truck, hot, truck_slots).alias("truck_slot"),
            every_slot(hot, traffic_slots).alias("traffic_slot"),
        )
        hot = is_hot(traffic, cfg)
        right = traffic.select(
            *right.columns,
            own_slot(traffic, hot, traffic_slots).alias("traffic_slot"),
            every_slot(hot, truck_slots).alias("truck_slot"),
        )
        keys += ["truck_slot", "traffic_slot"]
    return left, right, keys


def dealt_out(rows: DataFrame) -> DataFrame:
    """Rows in equal numbers on more tasks than there are cores.

    Where the readings are broadcast, what a row is joined with and repeated to is made in the
    task that holds it, so how the input was cut into files must not decide on the tasks.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(parts, 2 * spark.sparkContext.defaultParallelism))


def reading_levels(
    readings: DataFrame, keys: Sequence[str], least: Sequence[str] = (), most: Sequence[str] = ()
) -> DataFrame:
    """Readings with equal ``keys`` as one row with their ``_levels``, or one per 64
    neighbouring levels if there are others. ``least`` and ``most`` are columns of which the
    row gets the lowest or highest value."""
    ends = [F.min(c).alias(c) for c in least] + [F.max(c).alias(c) for c in most]
    counts = readings.groupBy(*keys, "congestion_level").agg(
        F.count(F.lit(1)).alias(COPIES), *ends
    )
    span = F.floor(F.col("congestion_level") / F.lit(_SPAN)).alias("_span")
    levels = F.collect_list(F.struct("congestion_level", COPIES)).alias(LEVELS)
    return counts.groupBy(*keys, span).agg(levels, *ends).drop("_span")


def truck_packs(rows: DataFrame, least: Sequence[str] = (), most: Sequence[str] = ()) -> DataFrame:
    """Truck rows of one route and batch (``bw``) in arrays of some 256 records, ``_trucks``,
    dealt by their ``pos``, however many there are. ``least`` and ``most`` as for
    ``reading_levels``, ``hot`` is kept."""
    ends = [F.min(c).alias(c) for c in least] + [F.max(c).alias(c) for c in most]
    sizes = rows.groupBy(F.col("bw").alias("_bw"), F.col("route_id").alias("_route")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(_PACK)).alias("_packs")
    )
    same = F.col("bw").eqNullSafe(F.col("_bw")) & F.col("route_id").eqNullSafe(F.col("_route"))
    pack = F.pmod(F.xxhash64("pos"), F.col("_packs"))
    records = F.collect_list(F.struct(*names(ENRICHED_TRUCK_FIELDS))).alias(TRUCKS)
    dealt = rows.join(sizes, same).withColumn("_pack", pack)
    return dealt.groupBy("bw", "route_id", "hot", "_pack").agg(records, *ends).drop("_pack")


def enriched_levels(
    truck: DataFrame,
    traffic: DataFrame,
    cfg: FleetConfig,
    salts: tuple[int, int] | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """The rows of ``enrich_join``, each truck row once with the ``_levels`` it has met.

    The number of rows grows with the truck rows alone, as long as there are few levels;
    ``by_level`` makes groups of them. Truck rows are dealt out before the join.
    """
    left, right, keys = _join_sides(truck, traffic, cfg, salts, extra)
    return (
        dealt_out(with_batch(left, cfg))
        .join(reading_levels(with_batch(right, cfg), keys), keys, "inner")
        .select("bw", *names(ENRICHED_TRUCK_FIELDS), LEVELS, *extra)
    )


def by_level(rows: DataFrame) -> DataFrame:
    """Rows with ``_levels`` as one per level, with ``congestion_level`` and ``_copies``."""
    if LEVELS not in rows.columns:
        return rows
    return rows.select(*[F.inline(c) if c == LEVELS else c for c in rows.columns])


def enriched_groups(
    truck: DataFrame,
    traffic: DataFrame,
    cfg: FleetConfig,
    salts: tuple[int, int] | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """The rows of ``enrich_join``, with equal readings met once and ``_copies`` telling
    their number.

    The join grows with the square of the rows per batch, what it costs to render, parse
    or score a row need not: whatever depends on the row alone is done here, and
    ``repeat_rows`` makes the rows at last. Readings that all differ are met one by one.
    """
    rows = by_level(enriched_levels(truck, traffic, cfg, salts, extra))
    return rows.select("bw", *names(ENRICHED_FIELDS), *extra, COPIES)


def repeat_rows(rows: DataFrame) -> DataFrame:
    """Every row as often as its ``_copies`` say, without that column."""
    others = [c for c in rows.columns if c != COPIES]
    left = F.col(COPIES) - F.col("_from")
    n = F.least(left, F.lit(_MOST_COPIES)).cast("int")
    starts = F.sequence(F.lit(0).cast("long"), F.col(COPIES) - 1, F.lit(_MOST_COPIES).cast("long"))
    # Few rows need more than one array, and a constant costs less than a sequence.
    few = F.col(COPIES).between(1, _MOST_COPIES)
    starts = F.when(few, F.array(F.lit(0).cast("long"))).otherwise(starts)
    return (
        rows.withColumn("_from", F.explode(starts))
        .select(*others, F.explode(F.array_repeat(F.lit(True), n)).alias("_one"))
        .select(*others)
    )


def every_row(rows: DataFrame, select: Sequence[Column | str] | None = None) -> DataFrame:
    """Rows one by one, whether they come so, by level or with their levels. ``select`` has
    the wanted columns, which are worked out once for all equal rows."""
    rows = by_level(rows)
    copies = [c for c in rows.columns if c == COPIES]
    if select is not None:
        rows = rows.select(*select, *copies)
    return repeat_rows(rows) if copies else rows


def enrich_join(
    truck: DataFrame,
    traffic: DataFrame,
    cfg: FleetConfig,
    salts: tuple[int, int] | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Inner equi-join on route and logical batch, many to many.

    A truck row without a reading in its batch is lost; several readings fan it
    out. ``extra`` names further truck columns to keep. A stream joins row by row, so that
    a pair is there as soon as both its rows are; if its readings come with ``_levels``, so do
    the joined rows. Truck rows may come in ``_trucks``.
    """
    if not (truck.isStreaming or traffic.isStreaming):
        return repeat_rows(enriched_groups(truck, traffic, cfg, salts, extra))
    left, right, keys = _join_sides(truck, traffic, cfg, salts, extra)
    joined = with_batch(left, cfg).join(with_batch(right, cfg), keys, "inner")
    if TRUCKS in truck.columns:
        return joined.select("bw", F.inline(TRUCKS), reading_of(traffic), *extra)
    return joined.select("bw", *names(ENRICHED_TRUCK_FIELDS), reading_of(traffic), *extra)


def reading_counts(
    traffic: DataFrame, cfg: FleetConfig, slots: int = 1
) -> DataFrame:
    """How many readings each route had in each logical batch.

    Statistics, training and scores do not use the congestion level, so for them
    the join's fan-out is only a multiplicity. Counting it first turns the
    many-to-many join into a lookup and never forms the n x m rows. With ``slots`` the
    count of a hot group has a copy for each ``slot``.
    """
    rows = traffic.select("arrival", "route_id")
    keys = ["bw", "route_id"]
    if slots > 1:
        rows = traffic.select("arrival", "route_id", is_hot(traffic, cfg).alias("is_hot"))
        keys.append("is_hot")
    counts = with_batch(rows, cfg).groupBy(*keys).agg(F.count(F.lit(1)).alias("readings"))
    if slots > 1:
        counts = counts.withColumn("slot", every_slot(F.col("is_hot"), slots)).drop("is_hot")
    return counts


def latest_traffic(
    traffic: DataFrame, tie_breaker: str = "event_time"
) -> DataFrame:
    """Newest reading per route by arrival, then by the tie breaker, then the higher
    level.

    One struct is both the order and the result, so equal times can't be decided by the
    order of the rows. It makes a task sort its rows by route before it combines them;
    what is shuffled is still one row per task and route.
    """
    newest = F.max(F.struct("arrival", tie_breaker, "congestion_level")).alias("newest")
    return (
        traffic.groupBy("route_id")
        .agg(newest)
        .select("route_id", "newest.congestion_level", "newest.arrival")
    )


def preview(enriched: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows in a fixed order; a per-partition top-k, not a full sort."""
    columns = names(ENRICHED_FIELDS)
    return enriched.select(*columns).orderBy(*columns).limit(rows)
