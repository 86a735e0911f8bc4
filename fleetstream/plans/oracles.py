"""The same queries as SQL over the same tables."""

from __future__ import annotations

from fleetstream.operators.training import moment_names
from fleetstream.plans.catalog import (
    DEMO_WEIGHTS,
    LATE_DELAY,
    LATE_SLICES,
    LOGISTIC_ITERATIONS,
    LOGISTIC_STEP,
)
from fleetstream.plans.telemetry import SCALED
from fleetstream.schemas import (
    ENRICHED_FIELDS,
    ENRICHED_TRUCK_FIELDS,
    FEATURES,
    KNOWN_VIOLATIONS,
    TRAFFIC_FIELDS,
    TRUCK_FIELDS,
    names,
)

_TRUCK = """truck AS (
  SELECT ts AS arrival, event_id, epoch_us(ts) // 1000 AS event_time,
    CAST(event_id % 50 AS INT) AS truck_id, CAST(user_id AS INT) AS driver_id,
    concat('driver ', user_id) AS driver_name,
    CAST(user_id % 10 AS INT) AS route_id, concat('route ', user_id % 10) AS route_name,
    30 + (event_id % 1000) / CAST(100 AS DOUBLE) AS latitude,
    -90 - (user_id % 7) / CAST(8 AS DOUBLE) AS longitude,
    CAST(floor(value) AS INT) AS speed,
    CASE event_type WHEN 'click' THEN 'Normal' WHEN 'error' THEN 'Speeding'
      WHEN 'purchase' THEN 'Lane Departure' ELSE 'Violation' END AS event_type,
    CAST(event_id % 2 AS INT) AS foggy, CAST(user_id % 2 AS INT) AS rainy,
    CAST(event_id % 4 AS INT) AS windy
  FROM events WHERE event_type <> 'view')"""

_TRAFFIC = """traffic AS (
  SELECT ts AS arrival, event_id, epoch_us(ts) // 1000 AS event_time,
    CAST(user_id % 10 AS INT) AS route_id,
    CAST(floor(value) AS INT) % 10 AS congestion_level
  FROM events WHERE event_type = 'view')"""

_JOINED = f"""{_TRUCK}, {_TRAFFIC}, joined AS (
  SELECT date_trunc('hour', t.arrival) AS bw, t.* EXCLUDE (arrival), f.congestion_level
  FROM truck t JOIN traffic f
    ON t.route_id = f.route_id
    AND date_trunc('hour', t.arrival) = date_trunc('hour', f.arrival))"""

_FLAG = "CASE WHEN event_type = 'Normal' THEN 0 ELSE 1 END"

_WINDOWS = f"""{_JOINED}, stats AS (
  SELECT bw - k * INTERVAL 1 HOUR AS window_start, driver_id,
    sum(speed) / count(*) AS average_speed, sum(foggy) / count(*) AS fog,
    sum(rainy) / count(*) AS rain, sum(windy) / count(*) AS wind,
    min({_FLAG}) AS total_violations, count(*) AS total_events,
    CAST(sum({_FLAG}) AS BIGINT) AS violation_count
  FROM joined, (VALUES (0), (1), (2)) s(k) GROUP BY 1, 2)"""

_ENRICHED = ", ".join(names(ENRICHED_FIELDS))
_STATS = (
    "window_start, driver_id, average_speed, fog, rain, wind, "
    "total_violations, total_events"
)


def _line(columns) -> str:
    return f"concat_ws('|', {', '.join(columns)})"


_RAW_TRUCK = _line([*names(ENRICHED_TRUCK_FIELDS), "'0'"])


def _with(ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{select}"


def _rounded(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


_SIZE = len(FEATURES)

_DOT = " + ".join(f"CAST({f} AS DOUBLE) * {w!r}" for f, w in zip(FEATURES, DEMO_WEIGHTS))

# Scaled features and the label, row by row.
_POINTS = (
    f"{_JOINED}, points AS (SELECT bw, event_id, event_time, truck_id, driver_id, congestion_level, "
    + ", ".join(
        f"(CAST({f} AS DOUBLE) - {o!r}) / {s!r} AS x{i}"
        for i, (f, o, s) in enumerate(
            zip(FEATURES, SCALED.scaling.offsets, SCALED.scaling.scales)
        )
    )
    + f", CAST({_FLAG} AS DOUBLE) AS y FROM joined)"
)


def _sums(group: str) -> str:
    """Moments of the points as lists: one row of xx per feature, then xy."""
    xx = ", ".join(
        "[" + ", ".join(f"sum(x{i} * x{j})" for j in range(_SIZE)) + f"] AS a{i}"
        for i in range(_SIZE)
    )
    xy = "[" + ", ".join(f"sum(x{i} * y)" for i in range(_SIZE)) + "] AS b"
    return f"SELECT {group}, CAST(count(*) AS DOUBLE) AS n, {xx}, {xy} FROM points GROUP BY ALL"


def _move(source: str, t: int) -> str:
    """Weights after step t as a list, from the list ``source``."""
    rate = f"{SCALED.step_size!r} / sqrt({t})"
    return (
        "["
        + ", ".join(
            f"{source}[{i + 1}] - {rate} * (list_dot_product(a{i}, {source}) - b[{i + 1}]) / n"
            for i in range(_SIZE)
        )
        + "]"
    )


def _steps(source: str, carried: str) -> str:
    """Three steps from a source of (w, moments); stops after two if they converge."""
    zeros = "[" + ", ".join(["CAST(0 AS DOUBLE)"] * _SIZE) + "]"
    return f"""SELECT {carried}, CASE WHEN list_distance(w2, w1)
      < {SCALED.convergence_tol!r} * greatest(list_distance(w2, {zeros}), 1.0)
    THEN w2 ELSE {_move('w2', 3)} END AS w
  FROM (SELECT *, {_move('w1', 2)} AS w2
    FROM (SELECT *, {_move('w', 1)} AS w1 FROM {source}))"""


_ZEROS = "[" + ", ".join(["CAST(0 AS DOUBLE)"] * _SIZE) + "]"

_TRAINED = f"""{_POINTS}, moments AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY bw) AS k FROM ({_sums('bw')})),
trained AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS TIMESTAMP) AS bw,
    CAST(NULL AS DOUBLE) AS n, {_ZEROS} AS w
  UNION ALL
  {_steps('(SELECT m.*, t.w FROM trained t JOIN moments m ON m.k = t.k + 1)', 'k, bw, n')})"""

_POSITIONS = ", ".join(f"({i})" for i in range(_SIZE))

_BROKEN = f"""{_TRUCK}, broken AS (
  SELECT *, concat_ws('|', {', '.join(
      "CASE WHEN event_type = 'Speeding' THEN concat(speed, '.5') "
      "ELSE CAST(speed AS VARCHAR) END" if c == "speed" else c
      for c in names(ENRICHED_TRUCK_FIELDS)
  )}, CASE WHEN event_type = 'Violation' THEN '' ELSE '0' END) AS value
  FROM truck)"""

_MOMENT_COLUMNS = ", ".join(
    f"{_rounded('n')} AS n"
    if c == "n"
    else f"{_rounded('b[%d]' % (int(c.split('_')[1]) + 1))} AS {c}"
    if c.startswith("xy")
    else f"{_rounded('a%s[%d]' % (c.split('_')[1], int(c.split('_')[2]) + 1))} AS {c}"
    for c in moment_names(_SIZE)
)

ORACLES: dict[str, str] = {
    "source_truck_lines": _with(
        _TRUCK,
        f"SELECT arrival, {_line([*names(ENRICHED_TRUCK_FIELDS), chr(39) + '0' + chr(39)])}"
        " AS value FROM truck",
    ),
    "source_traffic_lines": _with(
        _TRAFFIC,
        f"SELECT arrival, {_line(names(TRAFFIC_FIELDS))} AS value FROM traffic",
    ),
    "parse_truck": _with(
        _TRUCK, f"SELECT arrival, {', '.join(names(ENRICHED_TRUCK_FIELDS))} FROM truck"
    ),
    "parse_traffic": _with(
        _TRAFFIC, f"SELECT arrival, {', '.join(names(TRAFFIC_FIELDS))} FROM traffic"
    ),
    "parse_enriched": _with(_JOINED, f"SELECT {_ENRICHED} FROM joined"),
    "parse_truck_permissive": _with(
        _TRUCK,
        f"SELECT arrival, {', '.join(names(ENRICHED_TRUCK_FIELDS))} FROM truck "
        "WHERE event_type NOT IN ('Speeding', 'Violation')",
    ),
    "quarantine": _with(
        _BROKEN,
        "SELECT arrival, value, CASE event_type WHEN 'Speeding' THEN 'bad speed' "
        "ELSE 'expected 14 fields, found 13' END AS reason FROM broken "
        "WHERE event_type IN ('Speeding', 'Violation')",
    ),
    "truck_lines": _with(
        _TRUCK, f"SELECT {_line(names(TRUCK_FIELDS))} AS value FROM truck"
    ),
    "enriched_truck_lines": _with(
        _TRUCK, f"SELECT {_line(names(ENRICHED_TRUCK_FIELDS))} AS value FROM truck"
    ),
    "traffic_lines": _with(
        _TRAFFIC, f"SELECT {_line(names(TRAFFIC_FIELDS))} AS value FROM traffic"
    ),
    "violation_flag": _with(
        _TRUCK, f"SELECT event_id, event_type, {_FLAG} AS is_violation FROM truck"
    ),
    "known_violation_filter": _with(
        _TRUCK,
        "SELECT event_id, event_type FROM truck WHERE event_type IN ("
        + ", ".join(f"'{v}'" for v in KNOWN_VIOLATIONS)
        + ")",
    ),
    "enrich_join": _with(_JOINED, f"SELECT bw, {_ENRICHED} FROM joined"),
    "enriched_lines": _with(
        _JOINED, f"SELECT {_line(names(ENRICHED_FIELDS))} AS value FROM joined"
    ),
    "enriched_history": _with(_JOINED, f"SELECT bw, {_ENRICHED} FROM joined"),
    "preview_enriched": _with(
        _JOINED, f"SELECT {_ENRICHED} FROM joined ORDER BY {_ENRICHED} LIMIT 10"
    ),
    "driver_window_stats": _with(_WINDOWS, f"SELECT {_STATS} FROM stats"),
    "driver_window_stats_direct": _with(_WINDOWS, f"SELECT {_STATS} FROM stats"),
    "driver_window_violation_count": _with(
        _WINDOWS, "SELECT window_start, driver_id, violation_count FROM stats"
    ),
    "window_stats_lines": _with(
        _WINDOWS,
        "SELECT "
        + _line(
            [
                "driver_id",
                *[
                    f"CAST({c} AS FLOAT)"
                    for c in ("average_speed", "fog", "rain", "wind")
                ],
                "total_violations",
                "total_events",
            ]
        )
        + " AS value FROM stats",
    ),
    "window_stats_history": _with(_WINDOWS, f"SELECT {_STATS} FROM stats"),
    "latest_traffic_state": _with(
        _TRAFFIC,
        "SELECT route_id, arg_max(congestion_level, (arrival, event_id)) AS "
        "congestion_level, max(arrival) AS arrival FROM traffic GROUP BY route_id",
    ),
    "feature_vectors": _with(
        _JOINED,
        "SELECT event_id, congestion_level, "
        + ", ".join(f"CAST({f} AS DOUBLE) AS x_{f}" for f in FEATURES)
        + " FROM joined",
    ),
    "labeled_points": _with(
        _JOINED,
        f"SELECT event_id, congestion_level, CAST({_FLAG} AS DOUBLE) AS label, position, "
        "CASE position "
        + " ".join(f"WHEN {i} THEN CAST({f} AS DOUBLE)" for i, f in enumerate(FEATURES))
        + f" END AS feature FROM joined, (VALUES {_POSITIONS}) p(position)",
    ),
    "predict": _with(
        _JOINED,
        f"SELECT event_id, congestion_level, {_rounded(_DOT)} AS prediction FROM joined",
    ),
    "predict_logistic": _with(
        _JOINED,
        "SELECT event_id, congestion_level, "
        f"{_rounded(f'1.0 / (1.0 + exp(-({_DOT} + 0.25)))')} AS prediction FROM joined",
    ),
    "prediction_lines": _with(
        _JOINED,
        f"SELECT CAST(CAST(round({_DOT}, 6) AS DECIMAL(20, 6)) AS VARCHAR) AS value "
        "FROM joined",
    ),
    "training_moments": _with(
        _POINTS, f"SELECT bw, {_MOMENT_COLUMNS} FROM ({_sums('bw')})"
    ),
    "sgd_train_step": _with(
        _POINTS,
        f"SELECT position, {_rounded('w[position + 1]')} AS weight FROM ("
        + _steps(f"(SELECT *, {_ZEROS} AS w FROM ({_sums('0 AS g')}))", "n")
        + f"), (VALUES {_POSITIONS}) p(position)",
    ),
    "weights_history": _with(
        _TRAINED,
        f"SELECT bw, n AS rows, position, {_rounded('w[position + 1]')} AS weight "
        f"FROM trained, (VALUES {_POSITIONS}) p(position) WHERE k > 0",
        recursive=True,
    ),
    "model_weights_init": _with(
        _TRAINED,
        f"SELECT position, {_rounded('w[position + 1]')} AS weight "
        f"FROM trained, (VALUES {_POSITIONS}) p(position) "
        "WHERE k = (SELECT max(k) FROM trained)",
        recursive=True,
    ),
    "prequential_scores": _with(
        _TRAINED,
        "SELECT p.bw, event_id, congestion_level, t.bw AS weights_bw, "
        + _rounded(" + ".join(f"x{i} * w[{i + 1}]" for i in range(_SIZE)))
        + " AS prediction FROM points p JOIN moments m ON p.bw = m.bw "
        "JOIN trained t ON t.k = m.k - 1",
        recursive=True,
    ),
    "stream_scores": _with(
        _TRAINED,
        "SELECT p.bw, event_time, truck_id, driver_id, congestion_level, "
        "t.bw AS weights_bw, "
        + _rounded(" + ".join(f"x{i} * w[{i + 1}]" for i in range(_SIZE)))
        + " AS prediction FROM points p JOIN moments m ON p.bw = m.bw "
        "JOIN trained t ON t.k = m.k - 1",
        recursive=True,
    ),
    "stream_latest_traffic": _with(
        _TRAFFIC,
        "SELECT route_id, arg_max(congestion_level, (arrival, event_time, congestion_level)) AS "
        "congestion_level, max(arrival) AS arrival FROM traffic GROUP BY route_id",
    ),
    "stream_latest_snapshot": _with(
        _JOINED,
        f"SELECT bw, {_ENRICHED} FROM joined WHERE bw >= ("
        "SELECT date_trunc('day', min(arrival)) + date_diff('day', min(arrival), max(arrival)) "
        "// 2 * INTERVAL 1 DAY FROM truck)",
    ),
    "stream_late_rows": _with(
        f"{_TRUCK}, {_TRAFFIC}, came AS ("
        f"SELECT 'truck' AS input, arrival, event_id, {_RAW_TRUCK} AS value FROM truck UNION ALL "
        f"SELECT 'traffic', arrival, event_id, {_line(names(TRAFFIC_FIELDS))} FROM traffic), "
        f"reached AS (SELECT input, event_id % {LATE_SLICES} AS slice, max(arrival) AS last "
        "FROM came GROUP BY ALL)",
        "SELECT input, arrival, value, CASE WHEN arrival < (SELECT max(last) FROM reached r "
        f"WHERE r.input = came.input AND slice < event_id % {LATE_SLICES}) "
        f"- INTERVAL '{LATE_DELAY}' THEN 'late' ELSE 'admitted' END AS reason FROM came",
    ),
}
# A replayed stream must end where the batch query does.
ORACLES["stream_enriched_history"] = ORACLES["enriched_history"]
ORACLES["stream_window_stats"] = ORACLES["driver_window_stats"]
ORACLES["stream_weights"] = ORACLES["weights_history"]

_GROUPED = (
    f"{_POINTS}, grouped AS (SELECT "
    + ", ".join(f"x{i}" for i in range(_SIZE))
    + ", y, count(*) AS c FROM points GROUP BY ALL)"
)
_MARGIN = " + ".join(f"x{i} * w[{i + 1}]" for i in range(_SIZE))
_LOGISTIC = f"""{_GROUPED}, logistic AS (
  SELECT 0 AS t, {_ZEROS} AS w
  UNION ALL
  SELECT t + 1, [{", ".join(
      f"w[{i}] - {LOGISTIC_STEP} / sqrt(t + 1) * g[{i}]" for i in range(1, _SIZE + 1))}]
  FROM (SELECT t, w, [{", ".join(
      f"sum(c * (p - y) * x{i}) / sum(c)" for i in range(_SIZE))}] AS g
    FROM (SELECT t, w, c, y, {", ".join(f"x{i}" for i in range(_SIZE))},
        1 / (1 + exp(-({_MARGIN}))) AS p
      FROM logistic, grouped WHERE t < {LOGISTIC_ITERATIONS})
    GROUP BY t, w))"""
_FITTED = f"(SELECT w FROM logistic WHERE t = {LOGISTIC_ITERATIONS})"

ORACLES["train_logistic_batch"] = _with(
    _LOGISTIC,
    f"SELECT position, {_rounded('w[position + 1]')} AS weight "
    f"FROM logistic, (VALUES {_POSITIONS}) p(position) WHERE t = {LOGISTIC_ITERATIONS}",
    recursive=True,
)
ORACLES["train_logistic_history"] = ORACLES["train_logistic_batch"]
ORACLES["weights_from_pretrained"] = _with(
    _TRAINED.replace(_POINTS, _LOGISTIC).replace(
        f"AS n, {_ZEROS} AS w", f"AS n, {_FITTED} AS w"
    ),
    f"SELECT bw, n AS rows, position, {_rounded('w[position + 1]')} AS weight "
    f"FROM trained, (VALUES {_POSITIONS}) p(position) WHERE k > 0",
    recursive=True,
)
