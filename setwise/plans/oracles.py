"""The catalog's queries in SQL, written independently of the Spark operators."""

from __future__ import annotations

from setwise.contract import DOWN_MODEL, FOLDS, SET_MODEL, SPLIT_SEED, TRAIN_PERCENT, UP_MODEL

# One session per user.
_SESSIONS = """
s AS (
  SELECT user_id AS filename, event_id, event_type, value,
    (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id))::BIGINT AS time_us,
    (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id))::DOUBLE / 1e6::DOUBLE AS time_vector,
    (event_type IN ('click', 'error', 'purchase'))::INTEGER AS trough,
    (event_type IN ('view', 'error'))::INTEGER AS peak,
    (event_type IN ('purchase', 'error'))::INTEGER AS start_end_excercise
  FROM events)"""

_W = "OVER (PARTITION BY filename ORDER BY time_us, event_id)"
_SO_FAR = (
    "OVER (PARTITION BY filename ORDER BY time_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)


def _s(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([_SESSIONS, *ctes]) + "\n" + body


# First run of pressed buttons, class, blanked markers: from table `source`.
def _first(source: str = "s") -> list[str]:
    return [
        f"""
pressed AS (
  SELECT *, (trough + peak + start_end_excercise > 0)::INTEGER AS p,
    row_number() {_W} - row_number() OVER (PARTITION BY filename, (trough + peak + start_end_excercise > 0)
      ORDER BY time_us, event_id) AS grp
  FROM {source})""",
        """
first_grp AS (
  SELECT filename, min(grp) AS grp FROM pressed WHERE p = 1 GROUP BY filename)""",
        """
fr AS (
  SELECT pressed.*, coalesce(p = 1 AND pressed.grp = first_grp.grp, false)::INTEGER AS first_run
  FROM pressed LEFT JOIN first_grp USING (filename))""",
        """
coded AS (
  SELECT *, coalesce(max(CASE WHEN first_run = 1 THEN 4 * start_end_excercise + 2 * peak + trough END)
      OVER (PARTITION BY filename), 0)::INTEGER AS excercise_id
  FROM fr)""",
        """
blank AS (
  SELECT filename, event_id, event_type, value, time_us, time_vector, excercise_id,
    CASE WHEN first_run = 1 THEN 0 ELSE trough END AS trough,
    CASE WHEN first_run = 1 THEN 0 ELSE peak END AS peak,
    CASE WHEN first_run = 1 THEN 0 ELSE start_end_excercise END AS start_end_excercise
  FROM coded)""",
    ]


def _latch(source: str) -> list[str]:
    return [
        f"""
lagged AS (SELECT *, lag(start_end_excercise) {_W} AS before FROM {source})""",
        f"""
counted AS (
  SELECT *, sum((start_end_excercise = 1 AND before = 0)::INTEGER) {_SO_FAR} AS rises,
    sum((start_end_excercise = 0 AND before = 1)::INTEGER) {_SO_FAR} AS falls
  FROM lagged)""",
        """
latched AS (
  SELECT *, (coalesce(rises, 0) % 2 = 1 OR coalesce(falls, 0) % 2 = 1)::INTEGER AS latch FROM counted)""",
    ]


def _runs(source: str, flag: str, out: str, run: str, legacy: bool = False) -> str:
    """CTEs that number the runs of `flag`."""
    if legacy:
        return f"""
{out} AS (
  SELECT *, row_number() {_W} - row_number() OVER (PARTITION BY filename, {flag} ORDER BY time_us, event_id) AS {run}
  FROM {source})"""
    return f"""
{out}_change AS (
  SELECT *, ({flag} IS DISTINCT FROM lag({flag}) {_W} OR row_number() {_W} = 1)::INTEGER AS {out}_new FROM {source}),
{out} AS (SELECT *, sum({out}_new) {_SO_FAR} AS {run} FROM {out}_change)"""


def _label(legacy: bool = False) -> list[str]:
    return [
        *_first(),
        *_latch("blank"),
        "\nactive AS (SELECT *, CASE WHEN latch = 1 THEN excercise_id ELSE 0 END AS active FROM latched)",
        _runs("active", "latch", "latch_runs", "latch_run", legacy),
        """
timed AS (
  SELECT *, time_us - min(time_us) OVER (PARTITION BY filename, latch_run) AS relative_time,
    (active <> 0 AND peak = 0 AND trough = 0)::INTEGER AS inside
  FROM latch_runs)""",
        f"""
near AS (
  SELECT *, (inside = 1 AND (coalesce(lag(peak) {_W} = 1, false) OR coalesce(lead(trough) {_W} = 1, false)))::INTEGER AS dn,
    (inside = 1 AND (coalesce(lag(trough) {_W} = 1, false) OR coalesce(lead(peak) {_W} = 1, false)))::INTEGER AS up
  FROM timed)""",
        _runs("near", "inside", "inside_runs", "inside_run", legacy),
        """
labelled AS (
  SELECT filename, event_id, event_type, value, time_us, time_vector, relative_time, trough, peak,
    latch AS start_end_excercise, excercise_id, active AS start_end_excercise_id,
    max(dn) OVER (PARTITION BY filename, inside_run) AS eccentric,
    max(up) OVER (PARTITION BY filename, inside_run) AS concentric
  FROM inside_runs)""",
    ]


_LABELLED = """SELECT filename, event_id, relative_time::BIGINT AS relative_time, trough, peak,
  start_end_excercise, excercise_id, start_end_excercise_id, eccentric, concentric FROM labelled"""

_CODE = "CASE event_type WHEN 'purchase' THEN 7 WHEN 'view' THEN 5 ELSE 0 END"


def _named(code: str) -> str:
    return f"CASE {code} WHEN 7 THEN 'Squat' WHEN 5 THEN 'Deadlift' ELSE 'Unknown' END"


def _marked(legacy: bool = False) -> list[str]:
    rest = (
        "CASE WHEN eccentric = 0 OR concentric = 0 THEN time_us ELSE 0 END"
        if legacy
        else "CASE WHEN eccentric = 0 AND concentric = 0 THEN time_us END"
    )
    return [
        *_label(),
        f"""
smooth AS (
  SELECT * REPLACE ({_named(f'''max(start_end_excercise_id) OVER (PARTITION BY filename
    ORDER BY time_us, event_id ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING)''')} AS start_end_excercise_id) FROM labelled)""",
        """
moving AS (
  SELECT *, (start_end_excercise_id <> 'Unknown' AND concentric <> eccentric)::INTEGER AS events FROM smooth)""",
        _runs("moving", "events", "moves", "events_groups", legacy),
        f"""
marked AS (
  SELECT *, CASE WHEN concentric = 1 THEN time_us END AS concentric_time,
    CASE WHEN eccentric = 1 THEN time_us END AS eccentric_time, {rest} AS rest_time
  FROM moves)""",
        """
phase_rows AS (
  SELECT filename, events_groups, start_end_excercise_id,
    max(concentric_time) - min(concentric_time) AS concentric_time,
    max(eccentric_time) - min(eccentric_time) AS eccentric_time,
    max(rest_time) - min(rest_time) AS rest_time, min(time_us) AS phase_start
  FROM marked GROUP BY filename, events_groups, start_end_excercise_id)""",
    ]


_PHASE_W = "OVER (PARTITION BY filename ORDER BY phase_start, events_groups, start_end_excercise_id)"
_SETS = [
    f"""
known AS (
  SELECT *, (start_end_excercise_id <> 'Unknown')::INTEGER AS known,
    (row_number() {_PHASE_W} = 1 OR (start_end_excercise_id <> 'Unknown')
      IS DISTINCT FROM lag(start_end_excercise_id <> 'Unknown') {_PHASE_W})::INTEGER AS fresh
  FROM phase_rows)""",
    f"""
sets AS (
  SELECT *, sum(fresh) {_PHASE_W[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS group_id FROM known)""",
]

_SPANS = "concentric_time, eccentric_time, rest_time"
_PHASES = f"""SELECT filename, events_groups::BIGINT AS events_groups, start_end_excercise_id, {_SPANS}, phase_start
FROM phase_rows"""

_SUMMARY = [
    """
votes AS (
  SELECT filename, start_end_excercise_id AS name,
    row_number() OVER (PARTITION BY filename ORDER BY count(*) DESC, start_end_excercise_id) AS place
  FROM sets WHERE known = 1 GROUP BY filename, start_end_excercise_id)""",
    """
totals AS (
  SELECT filename, count(DISTINCT CASE WHEN known = 1 THEN group_id END) AS sets,
    (count(*) FILTER (concentric_time > 0) + count(*) FILTER (eccentric_time > 0))::DOUBLE / 2 AS reps,
    sum(concentric_time)::BIGINT AS total_concentric_time, sum(eccentric_time)::BIGINT AS total_eccentric_time,
    sum(rest_time)::BIGINT AS total_rest_time, avg(concentric_time) AS avg_concentric_time,
    avg(eccentric_time) AS avg_eccentric_time, avg(rest_time) AS avg_rest_time,
    count(*) FILTER (concentric_time > 0) AS count_concentric_times,
    count(*) FILTER (eccentric_time > 0) AS count_eccentric_times
  FROM sets GROUP BY filename)""",
]
_SUMMARY_BODY = """SELECT totals.*, coalesce(votes.name, 'Unknown') AS excercise
FROM totals LEFT JOIN votes ON votes.filename = totals.filename AND votes.place = 1"""

_DIRECTIONS = f"""
d AS (
  SELECT *, {_named(_CODE)} AS label, (event_type IN ('click', 'purchase', 'view'))::INTEGER AS up,
    (event_type IN ('error', 'purchase'))::INTEGER AS dn FROM s)"""

_NAMES = """
n AS (
  SELECT event_id, value, '/data/in/' || CASE WHEN event_type = 'error' THEN '20249999-999999_000000_MPU6500_'
    ELSE strftime(ts, '%Y%m%d-%H%M%S_%f') || CASE WHEN event_type = 'signup' THEN '_MPU9250_' ELSE '_MPU6500_' END
      || user_id::VARCHAR || '.csv' END AS path,
    CASE WHEN event_type <> 'error' THEN ts END AS started
  FROM events)"""

_TICKS = "floor(round(time_vector * 1000) / 10)::BIGINT"

_RUN_ID = "SELECT filename, event_id, peak, run_id::BIGINT AS run_id FROM r"

_ASOF = f"""
SELECT v.filename, v.event_id, v.time_us, c.value AS click_value, c.time_us AS click_us
FROM (SELECT * FROM s WHERE event_type = 'view') v
ASOF LEFT JOIN (SELECT * FROM s WHERE event_type = 'click') c
  ON v.filename = c.filename AND v.time_us >= c.time_us"""

_MERGED = """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderdate >= '1994-01-01' THEN o_totalprice * 1.1::DOUBLE ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders"""


def _changes(*picks: tuple[str, str, str]) -> str:
    """(kind, condition on the order date, price expression) per branch."""
    return " UNION ALL ".join(
        f"""SELECT o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, o_orderdate, o_orderpriority,
  {kind} FROM orders WHERE {condition}"""
        for kind, condition, price in picks
    )


_NEW_PRICE = "o_totalprice * 1.1::DOUBLE"
_BOTH = "o_orderdate >= '1994-01-01' AND o_orderdate < '1996-01-01'"

# What the models learn: inputs and labels are rules of the event type.
_LEARNED = f"""
l AS (
  SELECT user_id AS filename, event_id, value, {_CODE} AS start_end_excercise_id,
    CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 10 WHEN 'purchase' THEN 20 WHEN 'signup' THEN 30 ELSE 40 END::DOUBLE AS kind,
    (event_id % 3 - CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 10 WHEN 'purchase' THEN 20 WHEN 'signup' THEN 30 ELSE 40 END)::DOUBLE AS twin,
    (event_type IN ('click', 'purchase'))::INTEGER AS concentric, (event_type IN ('error', 'view'))::INTEGER AS eccentric
  FROM events)"""

_RECORDED = """
rec AS (
  SELECT '20240115-101112_000123_MPU6500_' || user_id::VARCHAR || '.csv' AS session, * FROM events)"""

_BUCKET = f"('0x' || substr(md5('{SPLIT_SEED}' || user_id::VARCHAR), 1, 8))::BIGINT % 100"


def _summary(*_: str) -> str:
    return _s(_SUMMARY_BODY, *_marked(), *_SETS, *_SUMMARY)


ORACLES: dict[str, str] = {
    "rising_edges": _s(f"""
SELECT filename, event_id, peak, coalesce(peak = 1 AND lag(peak) {_W} = 0, false)::INTEGER AS rising FROM s"""),
    "falling_edges": _s(f"""
SELECT filename, event_id, peak, coalesce(peak = 0 AND lag(peak) {_W} = 1, false)::INTEGER AS falling FROM s"""),
    "edges_chunked": _s(f"""
SELECT filename, event_id, coalesce(peak = 1 AND lag(peak) {_W} = 0, false)::INTEGER AS rising,
  coalesce(peak = 0 AND lag(peak) {_W} = 1, false)::INTEGER AS falling FROM s"""),
    "edge_counts": _s(
        """
SELECT filename, sum((peak = 1 AND b = 0)::INTEGER)::BIGINT AS rises, sum((peak = 0 AND b = 1)::INTEGER)::BIGINT AS falls
FROM e GROUP BY filename""",
        f"\ne AS (SELECT *, coalesce(lag(peak) {_W}, peak) AS b FROM s)",
    ),
    "island_runs": _s(_RUN_ID, _runs("s", "peak", "r", "run_id")),
    "island_runs_chunked": _s(_RUN_ID, _runs("s", "peak", "r", "run_id")),
    "island_legacy": _s(_RUN_ID, _runs("s", "peak", "r", "run_id", legacy=True)),
    "row_number_in_session": _s(f"SELECT filename, event_id, row_number() {_W} AS rn FROM s"),
    "first_run_class": _s("SELECT filename, event_id, first_run, excercise_id FROM coded", *_first()),
    "blank_first_run": _s("SELECT filename, event_id, trough, peak, start_end_excercise FROM blank", *_first()),
    "toggle_latch": _s("SELECT filename, event_id, latch FROM latched", *_latch("s")),
    "active_class": _s(
        "SELECT filename, event_id, latch, CASE WHEN latch = 1 THEN excercise_id ELSE 0 END AS active FROM latched",
        *_first(), *_latch("blank"),
    ),
    "relative_time": _s(
        """SELECT filename, event_id, latch,
  time_us - min(time_us) OVER (PARTITION BY filename, run) AS relative_time FROM r""",
        *_latch("s"), _runs("latched", "latch", "r", "run"),
    ),
    "phase_labels": _s(_LABELLED, *_label()),
    "phase_labels_chunked": _s(_LABELLED, *_label()),
    "phase_labels_legacy": _s(_LABELLED, *_label(legacy=True)),
    "rolling_max_101": _s(
        """SELECT filename, event_id, code, max(code) OVER (PARTITION BY filename ORDER BY time_us, event_id
  ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING) AS smooth FROM c""",
        f"\nc AS (SELECT *, {_CODE} AS code FROM s)",
    ),
    **{
        name: _s("""SELECT filename, event_id, max(value) OVER (PARTITION BY filename ORDER BY time_us, event_id
  ROWS BETWEEN 5 PRECEDING AND 3 FOLLOWING) AS highest FROM s""")
        for name in ("rolling_max_values", "rolling_max_chunked")
    },
    "label_map": _s(f"SELECT filename, event_id, {_CODE} AS code, {_named(_CODE)} AS label FROM s"),
    "xor_flag": _s(
        "SELECT filename, event_id, (label <> 'Unknown' AND up <> dn)::INTEGER AS events FROM d", _DIRECTIONS
    ),
    "time_markers": _s(
        """SELECT filename, event_id, CASE WHEN up = 1 THEN time_vector END AS concentric_time,
  CASE WHEN dn = 1 THEN time_vector END AS eccentric_time,
  CASE WHEN up = 0 AND dn = 0 THEN time_vector END AS rest_time FROM d""",
        _DIRECTIONS,
    ),
    "time_markers_legacy": _s(
        """SELECT filename, event_id, CASE WHEN up = 1 THEN time_vector END AS concentric_time,
  CASE WHEN dn = 1 THEN time_vector END AS eccentric_time,
  CASE WHEN up = 0 OR dn = 0 THEN time_vector ELSE 0 END AS rest_time FROM d""",
        _DIRECTIONS,
    ),
    **{
        name: _s(
            """SELECT filename, event_id, start_end_excercise_id, events, events_groups::BIGINT AS events_groups
FROM marked""",
            *_marked(),
        )
        for name in ("movement_runs", "movement_runs_chunked")
    },
    "phase_spans": _s(_PHASES, *_marked()),
    "phase_spans_chunked": _s(_PHASES, *_marked()),
    "phase_spans_legacy": _s(
        _PHASES.replace("rest_time,", "rest_time::DOUBLE AS rest_time,"), *_marked(legacy=True)
    ),
    "set_ids": _s(
        """SELECT filename, events_groups::BIGINT AS events_groups, start_end_excercise_id, phase_start,
  group_id::BIGINT AS group_id FROM sets""",
        *_marked(), *_SETS,
    ),
    "session_summary": _summary(),
    "session_summary_chunked": _summary(),
    "json_report": _summary(),
    "conditional_aggregates": """
WITH v AS (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place
  FROM events WHERE event_type <> 'signup' GROUP BY user_id, event_type)
SELECT e.user_id AS filename, count(DISTINCT e.event_type) FILTER (e.event_type <> 'signup') AS kinds,
  max(v.event_type) AS commonest, round(sum(value), 4) AS total, round(avg(value), 4) AS mean,
  count(*) FILTER (value > 50) AS above_50, count(*) AS n
FROM events e LEFT JOIN v ON v.user_id = e.user_id AND v.place = 1 GROUP BY e.user_id""",
    "raster_columns": _s(
        """SELECT filename, event_id, time_vector, ticks // 100 AS time_sec, (ticks // 10)::DOUBLE / 10 AS time_100ms,
  ticks::DOUBLE / 100 AS time_10ms, ((ticks % 100) // 10)::DOUBLE / 10 AS dec_100ms,
  (ticks % 10)::DOUBLE / 100 AS dec_10ms FROM t""",
        f"\nt AS (SELECT *, {_TICKS} AS ticks FROM s)",
    ),
    "downsample_ticks": _s(f"SELECT filename, event_id, time_vector FROM s WHERE {_TICKS} % 2 = 0"),
    "resample_condition": _s(f"SELECT filename, event_id, time_vector FROM s WHERE {_TICKS} % 10 = 0"),
    "clean_samples": """
SELECT l_orderkey, l_linenumber, l_discount, l_tax, pow(l_discount, -1.0) AS inverse FROM lineitem
WHERE l_discount <> 0 AND l_tax <> 0""",
    "clean_events": "SELECT user_id AS filename, event_id, value FROM events WHERE value <> 0",
    "infinite_to_nan": """
SELECT l_returnflag, count(*) FILTER (l_discount = 0) AS nans, count(*) FILTER (l_discount <> 0) AS numbers
FROM lineitem GROUP BY l_returnflag""",
    "route_split": _s(
        """SELECT filename, event_id, excercise_id,
  CASE WHEN excercise_id <> 0 THEN 'training' ELSE 'production' END AS route FROM coded""",
        *_first(),
    ),
    "rename_project": "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS price FROM orders",
    "project_without": "SELECT * EXCLUDE (p_size, p_retailprice) FROM part",
    "filter_contains": "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')",
    "where_sql": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000",
    "regex_fields": "WITH" + _NAMES + """
SELECT event_id, regexp_extract(path, '[^/]+$', 0) AS base_name,
  regexp_extract(path, '(\\d{8}-\\d{6}_\\d{6})', 1) AS stamp, regexp_extract(path, '(MPU\\d{4})', 1) AS device FROM n""",
    "url_base_name": "SELECT page_id, regexp_extract(url, '[^/]+$', 0) AS base_name FROM pages",
    "name_to_timestamp": "WITH" + _NAMES + "\nSELECT event_id, started FROM n",
    "event_wall_time": "WITH" + _NAMES + """
SELECT event_id, make_timestamp((epoch_us(started) + round(value * 1000000))::BIGINT) AS at,
  strftime(make_timestamp(floor(floor(epoch_us(started) / 1000000.0) + value)::BIGINT * 1000000), '%Y-%m-%d %H:%M:%S') AS at_text
FROM n""",
    "temperature_c": "SELECT user_id AS filename, event_id, round(value / 340.0 + 36.53::DOUBLE, 6) AS celsius FROM events",
    # The Hamilton product, once with the quaternion and once with its conjugate, over |q|^2.
    "world_frame": """
WITH p AS (SELECT vec_id, embedding AS e, unnest(range(0, 57, 7)) AS s FROM embeddings),
q AS (
  SELECT vec_id, s, e[s + 1]::DOUBLE AS x, e[s + 2]::DOUBLE AS y, e[s + 3]::DOUBLE AS z,
    e[s + 4]::DOUBLE AS w, e[s + 5]::DOUBLE AS i, e[s + 6]::DOUBLE AS j, e[s + 7]::DOUBLE AS k FROM p),
h AS (
  SELECT *, -i * x - j * y - k * z AS a, w * x + j * z - k * y AS b, w * y - i * z + k * x AS c,
    w * z + i * y - j * x AS d, w * w + i * i + j * j + k * k AS n FROM q)
SELECT vec_id, s::INTEGER AS start,
  round((-a * i + b * w - c * k + d * j) / nullif(n, 0), 6) AS wx,
  round((-a * j + b * k + c * w - d * i) / nullif(n, 0), 6) AS wy,
  round((-a * k - b * j + c * i + d * w) / nullif(n, 0), 6) AS wz FROM h""",
    "button_codes": _s("SELECT filename, event_id, 4 * start_end_excercise + 2 * peak + trough AS code FROM s"),
    "plot_traces": _s(
        """SELECT 'chest' AS sensor, value AS x, value + 2 AS y, value + 4 AS z, run_id::BIGINT AS color FROM r
UNION ALL SELECT 'wrist', value + 1 + 500, value + 3, value + 5, run_id::BIGINT FROM r""",
        _runs("s", "peak", "r", "run_id"),
    ),
    "semi_join_keys": """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "left_join_keys": """
SELECT o_orderkey, o_custkey AS c_custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "asof_hold_last": _s(_ASOF),
    "asof_hold_last_chunked": _s(_ASOF),
    "asof_heavy_right": """
WITH r AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS device, user_id, event_id, event_type, value, epoch_us(ts) AS ts_us FROM events),
c AS (SELECT DISTINCT device, ts_us FROM r WHERE event_type = 'click')
SELECT v.device, v.event_id, v.ts_us, c.ts_us AS click_us
FROM (SELECT * FROM r WHERE event_type = 'view' AND (device <> 0 OR user_id = 0 OR value > 90)) v
ASOF LEFT JOIN c ON v.device = c.device AND v.ts_us >= c.ts_us""",
    "top1_latest": "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1",
    "distinct_keys": "SELECT DISTINCT user_id FROM events",
    "sorted_scan": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey",
    "split_by_key": f"""
SELECT user_id AS filename, event_id, CASE WHEN {_BUCKET} < {TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS part
FROM events""",
    "confusion_metrics": """
WITH classes AS (SELECT quality AS c FROM labels UNION SELECT toxic FROM labels),
m AS (
  SELECT c, (SELECT count(*) FROM labels WHERE quality = c) AS a, (SELECT count(*) FROM labels WHERE toxic = c) AS b,
    (SELECT count(*) FROM labels WHERE quality = c AND toxic = c) AS h FROM classes),
r AS (
  SELECT *, CASE WHEN b = 0 THEN 0 ELSE h::DOUBLE / b END AS pr, CASE WHEN a = 0 THEN 0 ELSE h::DOUBLE / a END AS re FROM m)
SELECT round(sum(h)::DOUBLE / sum(a), 9) AS accuracy, round(sum(a * pr) / sum(a), 9) AS weighted_precision,
  round(sum(a * re) / sum(a), 9) AS weighted_recall,
  round(sum(a * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) / sum(a), 9) AS f1
FROM r""",
    "upsert": _MERGED,
    "upsert_by_name": _MERGED,
    "change_feed": _changes(
        ("'delete' AS _change_type", "o_orderdate < '1994-01-01'", "o_totalprice"),
        ("'update_preimage' AS _change_type", _BOTH, "o_totalprice"),
        ("'update_postimage' AS _change_type", _BOTH, _NEW_PRICE),
        ("'insert' AS _change_type", "o_orderdate >= '1996-01-01'", _NEW_PRICE),
    ),
    "upsert_changes": _changes(
        ("'insert' AS _change_type, 0::BIGINT AS _commit_version", "o_orderdate < '1996-01-01'", "o_totalprice"),
        ("'update_preimage' AS _change_type, 1::BIGINT AS _commit_version", _BOTH, "o_totalprice"),
        ("'update_postimage' AS _change_type, 1::BIGINT AS _commit_version", _BOTH, _NEW_PRICE),
        ("'insert' AS _change_type, 1::BIGINT AS _commit_version", "o_orderdate >= '1996-01-01'", _NEW_PRICE),
    ),
    "incremental_read": _changes(
        ("0::BIGINT AS read_version", "o_orderdate < '1996-01-01'", "o_totalprice"),
        ("1::BIGINT AS read_version", "o_orderdate >= '1996-01-01'", _NEW_PRICE),
    ),
    "upsert_duplicates": _MERGED,
    "upsert_null_partition": """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderdate >= '1994-01-01' THEN o_totalprice * 1.1::DOUBLE ELSE o_totalprice END AS o_totalprice,
  o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, listed
FROM orders, (SELECT unnest([true, false]) AS listed)""",
    "incremental_read_after_crash": _changes(
        ("0::BIGINT AS read_version", "o_orderdate < '1996-01-01'", "o_totalprice"),
        ("1::BIGINT AS read_version", "o_orderdate >= '1996-01-01'", _NEW_PRICE),
    ),
    "feed_after_retry": """
SELECT o_orderkey, CASE WHEN o_orderdate < '1996-01-01' THEN 0 WHEN o_orderdate < '1997-01-01' THEN 1 ELSE 2 END::BIGINT AS _commit_version
FROM orders""",
    "file_sizes": """
SELECT target, true AS capped, n FROM (SELECT count(*) AS n FROM events), (SELECT unnest(['catalog', 'path']) AS target)""",
    "capped_append": "SELECT event_id, user_id, value FROM events",
    "stream_ingest": "WITH" + _RECORDED + """
SELECT session AS filename, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id))::DOUBLE / 1e6::DOUBLE AS timevector,
  value AS ax1, value AS temp2, (event_type IN ('click', 'error', 'purchase'))::INTEGER AS button1,
  (event_type IN ('view', 'error'))::INTEGER AS button2, (event_type IN ('purchase', 'error'))::INTEGER AS button3,
  NULL::VARCHAR AS _rescued_data FROM rec""",
    "stream_silver": "WITH"
    + ",".join(
        [
            _SESSIONS.replace("\ns AS (", "\nall_s AS ("),
            "\ns AS (SELECT * FROM all_s WHERE value <> 0)",
            *_label(),
        ]
    )
    + """
SELECT '20240115-101112_000123_MPU6500_' || filename::VARCHAR || '.csv' AS filename, time_vector, value AS accelX_ws,
  CASE WHEN excercise_id <> 0
    THEN time_vector - first_value(time_vector) OVER (PARTITION BY filename, latch_run ORDER BY time_us) END AS relative_time,
  CASE WHEN excercise_id <> 0 THEN excercise_id END AS excercise_id,
  CASE WHEN excercise_id <> 0 THEN start_end_excercise_id END AS start_end_excercise_id,
  CASE WHEN excercise_id <> 0 THEN eccentric END AS eccentric,
  CASE WHEN excercise_id <> 0 THEN concentric END AS concentric,
  TIMESTAMP '2024-01-15 10:11:12.000123' AS measure_date,
  strftime(make_timestamp(floor(epoch_us(TIMESTAMP '2024-01-15 10:11:12') / 1000000.0 + time_vector)::BIGINT * 1000000),
    '%Y-%m-%d %H:%M:%S') AS "timestamp",
  'MPU6500' AS mpuVersion, CASE WHEN excercise_id <> 0 THEN 'training' ELSE 'production' END AS route
FROM labelled""".replace("FROM labelled", "FROM labelled JOIN (SELECT filename AS f, event_id AS e, latch_run FROM latch_runs) ON f = filename AND e = event_id"),
    "scaled_features": "WITH" + _LEARNED + """
SELECT filename, event_id, round((kind - avg(kind) OVER ()) / stddev_samp(kind) OVER (), 6) AS scaled_kind,
  round((twin - avg(twin) OVER ()) / stddev_samp(twin) OVER (), 6) AS scaled_twin,
  round((value - avg(value) OVER ()) / stddev_samp(value) OVER (), 6) AS scaled_value FROM l""",
    "fold_ids": f"""
SELECT DISTINCT user_id AS filename, (('0x' || substr(md5('{SPLIT_SEED + 1}' || user_id::VARCHAR), 1, 8))::BIGINT % {FOLDS})::INTEGER AS fold
FROM events""",
    "tree_scores": "WITH" + _LEARNED + """
SELECT filename, event_id, start_end_excercise_id, start_end_excercise_id::DOUBLE AS prediction FROM l""",
    "forest_scores": "WITH" + _LEARNED + "\nSELECT filename, event_id, concentric, concentric::DOUBLE AS prediction FROM l",
    "cv_by_group": """
SELECT 1::DOUBLE AS accuracy, 1::DOUBLE AS weighted_precision, 1::DOUBLE AS weighted_recall, 1::DOUBLE AS f1, 1::DOUBLE AS cv_f1""",
    "chained_scores": "WITH" + _LEARNED + """
SELECT filename, event_id, start_end_excercise_id::DOUBLE AS start_end_excercise_id, concentric::DOUBLE AS concentric,
  eccentric::DOUBLE AS eccentric FROM l""",
    "train_run": """
SELECT unnest(['set', 'up', 'down']) AS model, 1::DOUBLE AS accuracy, 1::DOUBLE AS weighted_precision,
  1::DOUBLE AS weighted_recall, 1::DOUBLE AS f1, 1::DOUBLE AS held_out_f1, 1::DOUBLE AS cv_f1""",
    "rescued_cells": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, (props::JSON ->> 'k')::INTEGER AS k,
  CASE WHEN event_type = 'error' THEN 'error' END AS rescued FROM events""",
}
# However the deliveries are cut, the tables are those of whole sessions.
ORACLES["stream_silver_split"] = ORACLES["stream_silver"]
ORACLES["capped_batches"] = "SELECT true AS several, true AS capped, count(*) AS n_rows FROM events"

# The scoring job with labels by rule, instead of those that buttons give.
_PREDICTED = f"""
labelled AS (
  SELECT filename, event_id, time_us, {_CODE} AS start_end_excercise_id,
    (event_type IN ('click', 'purchase'))::INTEGER AS concentric, (event_type IN ('error', 'view'))::INTEGER AS eccentric
  FROM s)"""
ORACLES["score_sessions"] = _s(
    """SELECT totals.* REPLACE (totals.filename::VARCHAR AS filename, total_concentric_time::DOUBLE AS total_concentric_time,
    total_eccentric_time::DOUBLE AS total_eccentric_time, total_rest_time::DOUBLE AS total_rest_time),
  NULL::TIMESTAMP AS measure_date, coalesce(votes.name, 'Unknown') AS excercise
FROM totals LEFT JOIN votes ON votes.filename = totals.filename AND votes.place = 1""",
    _PREDICTED, *_marked()[len(_label()):], *_SETS, *_SUMMARY,
)

# Models on the sessions' own labels: a prediction is the commonest label of the rows with
# equal inputs in the sessions that a model was fitted on, the smaller one among equals.
_OWN = [
    *_label(),
    f"""
l AS (
  SELECT filename, event_id, event_type, start_end_excercise_id AS told_set, concentric AS told_up, eccentric AS told_down,
    (('0x' || substr(md5('{SPLIT_SEED + 1}' || filename::VARCHAR), 1, 8))::BIGINT % {FOLDS})::INTEGER AS fold,
    ('0x' || substr(md5('{SPLIT_SEED}' || filename::VARCHAR), 1, 8))::BIGINT % 100 < {TRAIN_PERCENT} AS train
  FROM labelled)""",
    f"""
folds AS (SELECT unnest(range({FOLDS}))::INTEGER AS fold)""",
]


def _commonest(name: str, label: str, inputs: str, rows: str, key: str = "f.fold") -> str:
    """Votes of the rows outside a fold, or of those in ``rows``."""
    keys = f"{key}, {inputs}" if key else inputs
    return f"""
{name} AS (
  SELECT {f"{key} AS fold, " if key else ""}{inputs}, {label} AS p FROM {rows} GROUP BY {keys}, {label}
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {label}) = 1)"""


def _metrics(scored: str, told: str, said: str, by: str) -> str:
    """Accuracy and weighted precision, recall and F1 for each value of ``by``."""
    return f"""
SELECT {by}, sum(h) / sum(a) AS accuracy, sum(a * coalesce(h / nullif(b, 0), 0)) / sum(a) AS weighted_precision,
  sum(a * coalesce(h / nullif(a, 0), 0)) / sum(a) AS weighted_recall,
  sum(a * coalesce(2 * h / nullif(a + b, 0), 0)) / sum(a) AS f1
FROM (
  SELECT {by}, c, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b, sum(h)::DOUBLE AS h FROM (
    SELECT {by}, {told} AS c, 1 AS a, 0 AS b, ({told} = {said})::INTEGER AS h FROM {scored}
    UNION ALL SELECT {by}, {said}, 0, 1, 0 FROM {scored})
  GROUP BY {by}, c)
GROUP BY {by}"""


def _rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 9) AS {c}" for c in columns)


_MEASURES = ("accuracy", "weighted_precision", "weighted_recall", "f1")
_OUTSIDE = "l JOIN folds f ON l.fold <> f.fold"
_SET_SCORES = [
    _commonest("set_votes", "told_set", "event_type", _OUTSIDE),
    """
by_set AS (SELECT l.*, v.p AS said_set FROM l JOIN set_votes v USING (fold, event_type))""",
]
ORACLES["own_label_scores"] = _s(
    """SELECT filename, event_id, s.fold, s.told_set AS told_start_end_excercise_id, said_set::DOUBLE AS start_end_excercise_id,
  told_up AS told_concentric, u.p::DOUBLE AS concentric, told_down AS told_eccentric, d.p::DOUBLE AS eccentric
FROM by_set s LEFT JOIN up_votes u ON u.fold = s.fold AND u.event_type = s.event_type AND u.told_set = said_set
  LEFT JOIN down_votes d ON d.fold = s.fold AND d.event_type = s.event_type AND d.told_set = said_set""",
    *_OWN, *_SET_SCORES,
    _commonest("up_votes", "told_up", "event_type, told_set", _OUTSIDE),
    _commonest("down_votes", "told_down", "event_type, told_set", _OUTSIDE),
)
ORACLES["own_label_folds"] = _s(
    f"""SELECT n.fold, n, sessions, in_sets, {_rounded(*_MEASURES)}
FROM (SELECT fold, count(*) AS n, count(DISTINCT filename) AS sessions, count(*) FILTER (told_set <> 0) AS in_sets FROM l GROUP BY fold) n
JOIN measured USING (fold)""",
    *_OWN, *_SET_SCORES, f"\nmeasured AS ({_metrics('by_set', 'told_set', 'said_set', 'fold')})",
)


def _model_run(model: str, label: str, inputs: str) -> tuple[list[str], str]:
    """One model as ``train`` measures it: validated by fold on four fifths of the sessions,
    tested on the others; both fitted on the labels themselves."""
    n = label.removeprefix("told_")
    equal = " AND ".join(f"v.{c} = l.{c}" for c in inputs.split(", "))
    validated = f"(SELECT round(avg(f1), 9) FROM {n}_folds)" if inputs == "event_type" else "NULL::DOUBLE"
    ctes = [
        f"\n{n}_rows AS (SELECT * FROM l WHERE train)",
        _commonest(f"{n}_out", label, inputs, f"{n}_rows l JOIN folds f ON l.fold <> f.fold"),
        f"\n{n}_cv AS (SELECT l.*, v.p AS said FROM {n}_rows l JOIN {n}_out v ON v.fold = l.fold AND {equal})",
        f"\n{n}_folds AS ({_metrics(f'{n}_cv', label, 'said', 'fold')})",
        _commonest(f"{n}_all", label, inputs, f"{n}_rows", ""),
        f"\n{n}_test AS (SELECT '{model}' AS model, l.*, v.p AS said FROM l JOIN {n}_all v ON {equal} WHERE NOT train)",
        f"\n{n}_run AS ({_metrics(f'{n}_test', label, 'said', 'model')})",
    ]
    return ctes, f"""
SELECT model, {_rounded(*_MEASURES)}, {validated} AS cv_f1 FROM {n}_run"""


_MODEL_RUNS = [
    _model_run(SET_MODEL, "told_set", "event_type"),
    _model_run(UP_MODEL, "told_up", "event_type, told_set"),
    _model_run(DOWN_MODEL, "told_down", "event_type, told_set"),
]
ORACLES["own_label_run"] = _s(" UNION ALL ".join(body for _, body in _MODEL_RUNS), *_OWN, *[c for ctes, _ in _MODEL_RUNS for c in ctes])
