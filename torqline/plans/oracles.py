"""The same queries as plain SQL over the raw tables, for an independent engine.

Written against the definitions, not against the Spark plans: windows over whole tables
where the jobs use ranges, unions where they unpivot, and so on.
"""

from __future__ import annotations

from torqline import config as C
from torqline.plans.catalog import SIGMOIDS

ORACLES: dict[str, str] = {}


def _d(value) -> str:
    """A DOUBLE literal; bare decimals would be DECIMAL and round differently."""
    return f"CAST({value} AS DOUBLE)"


def _case(column: str, table: dict[str, float], default: float) -> str:
    branches = " ".join(f"WHEN {column} = '{key}' THEN {_d(value)}" for key, value in table.items())
    return f"CASE {branches} ELSE {_d(default)} END"


WATTS = f"(torque_nm * rotational_speed_rpm * {_d(2)} * {_d(C.PI)} / {_d(60)})"
GAP = "(process_temperature_kelvin - air_temperature_kelvin)"
RULES = {
    "twf": f"tool_wear_minutes >= {_case('machine_type', C.WEAR_LIMITS, C.WEAR_DEFAULT)}",
    "hdf": f"(rotational_speed_rpm < {_d(C.HDF_MAX_RPM)} AND {GAP} < {_d(C.HDF_MAX_GAP)})",
    "pwf": f"({WATTS} < {_d(C.PWF_MIN_WATTS)} OR {WATTS} > {_d(C.PWF_MAX_WATTS)})",
    "osf": f"torque_nm * tool_wear_minutes > {_case('machine_type', C.OSF_LIMITS, C.OSF_DEFAULT)}",
}
PHYSICS_TYPE = "CASE " + " ".join(f"WHEN {RULES[f]} THEN '{f}'" for f in C.FLAG_PRIORITY) + " ELSE 'none' END"
FLAGS = {f: f"CASE WHEN injected_failure <> 0 AND ({rule}) THEN 1 ELSE 0 END" for f, rule in RULES.items()}
FAILURE_TYPE = (
    "CASE WHEN injected_failure = 0 THEN 'none' "
    + " ".join(f"WHEN {RULES[f]} THEN '{f}'" for f in C.FLAG_PRIORITY)
    + " ELSE 'none' END"
)


def _class_index(name: str) -> str:
    branches = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(C.FAILURE_CLASSES))
    return f"CASE {name} {branches} END"


READINGS = f"""
raw AS (
  SELECT event_id AS id, ts AS "timestamp", event_id + 1 AS reading_number,
    concat('machine_', CAST(user_id AS VARCHAR)) AS machine_id,
    CASE WHEN event_id % 10 < 6 THEN 'L' WHEN event_id % 10 < 9 THEN 'M' ELSE 'H' END AS machine_type,
    CAST(2953 + (event_id * 7) % 92 AS DOUBLE) / {_d(10)} AS air_temperature_kelvin,
    CAST(3029 + (event_id * 7) % 92 + (event_id * 13) % 45 AS DOUBLE) / {_d(10)} AS process_temperature_kelvin,
    CAST(2000 - (38 + (event_id * 37) % 729) + (event_id * 11) % 300 AS DOUBLE) AS rotational_speed_rpm,
    CAST(38 + (event_id * 37) % 729 AS DOUBLE) / {_d(10)} AS torque_nm,
    CAST((event_id // 8) % 254 AS DOUBLE) AS tool_wear_minutes,
    CAST(CASE WHEN (event_id * 37) % 729 > 682 OR event_id % 97 = 0 THEN 1 ELSE 0 END AS INTEGER)
      AS injected_failure,
    CASE WHEN event_id % 4 = 0 THEN 'sudden-spike' ELSE 'normal' END AS mode
  FROM events
),
scored AS (
  SELECT *, {WATTS} / {_d(1000)} AS power_kw, {GAP} AS temp_diff_kelvin,
    torque_nm * tool_wear_minutes AS mechanical_stress,
    CAST(least(CAST(999 AS BIGINT), (id * 31) % 700 + 299 * injected_failure) AS DOUBLE) / {_d(1000)}
      AS failure_probability
  FROM raw
),
predicted AS (
  SELECT *, CAST(CASE WHEN failure_probability >= {_d(0.5)} THEN 1 ELSE 0 END AS INTEGER) AS predicted_failure
  FROM scored
),
readings AS (
  SELECT *, CASE WHEN predicted_failure = 1 THEN nullif({PHYSICS_TYPE}, 'none') END AS predicted_failure_type,
    CASE WHEN mode = 'sudden-spike' AND reading_number - 1 >= (SELECT count(*) FROM events) // 2
      THEN {_d(C.SPIKE_RATE)} ELSE {_d(C.BASE_FAILURE_RATE)} END AS effective_failure_rate
  FROM predicted
),
middle AS (SELECT (max(event_id) + 1) // 2 AS cut FROM events)
"""

DIRTY = """
dirty AS (
  SELECT * REPLACE (
    CASE WHEN id % 50 = 0 THEN torque_nm + CAST(100 AS DOUBLE) ELSE torque_nm END AS torque_nm,
    CASE WHEN id % 70 = 0 THEN 'X' ELSE machine_type END AS machine_type,
    CASE WHEN id % 90 <> 0 THEN tool_wear_minutes END AS tool_wear_minutes)
  FROM readings
)
"""

LABELLED = f"""
labelled AS (
  SELECT *, {FAILURE_TYPE} AS failure_type, coalesce(predicted_failure_type, 'none') AS predicted_type
  FROM readings
)
"""


def _sql(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = "WITH " + ",".join([READINGS, *ctes]) + body


SENSORS = ", ".join(C.SENSORS)
NUMERIC = ", ".join(C.NUMERIC_FEATURES)
AI4I = {snake: original for original, snake in C.AI4I_TO_SNAKE.items()}
AI4I_SENSORS = ", ".join(f'{s} AS "{AI4I[s]}"' for s in C.SENSORS)

# --- features --------------------------------------------------------------------------

_sql("engineer_features", f"SELECT id AS \"UDI\", machine_type AS type, {NUMERIC} FROM readings")
_sql("inverse_rename", f'SELECT id AS "UDI", machine_type AS "Type", {AI4I_SENSORS} FROM readings')
_sql("request_names", f'SELECT id AS "UDI", machine_type, {SENSORS} FROM readings')
_sql("feature_slice", f"SELECT machine_type AS type, {NUMERIC} FROM readings")
_sql("drift_projection", f"SELECT machine_type AS type, {NUMERIC} FROM readings")
_sql(
    "one_hot_type",
    "SELECT id, "
    + ", ".join(f"CASE WHEN machine_type = '{t}' THEN {_d(1)} ELSE {_d(0)} END AS \"type_{t}\"" for t in "HLM")
    + " FROM dirty",
    DIRTY,
)
_sql(
    "standard_scale",
    "SELECT id, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in C.NUMERIC_FEATURES)
    + " FROM readings",
)

# --- quality ------------------------------------------------------------------------------


def _bound(name: str) -> str:
    low, low_in, high, high_in = C.SENSOR_BOUNDS[name]
    return f"({name} {'>=' if low_in else '>'} {_d(low)} AND {name} {'<=' if high_in else '<'} {_d(high)})"


CHECKS = {"machine_type": "machine_type IN ('L', 'M', 'H')", **{name: _bound(name) for name in C.SENSOR_BOUNDS}}
VALID = " AND ".join(CHECKS.values())
_sql("valid_readings", f"SELECT id, machine_type, {SENSORS} FROM dirty WHERE {VALID}", DIRTY)
_sql(
    "quarantine_reasons",
    "SELECT id, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT coalesce({check}, false) THEN '{name}' END" for name, check in CHECKS.items())
    + f") AS reasons FROM dirty WHERE NOT coalesce({VALID}, false)",
    DIRTY,
)
# The derived features of a planted row keep their stored values, so only wear can be missing.
_sql(
    "drop_incomplete",
    f"SELECT id, machine_type AS type, {NUMERIC} FROM dirty WHERE tool_wear_minutes IS NOT NULL",
    DIRTY,
)
_sql(
    "since_filter",
    "SELECT id, \"timestamp\", machine_id, torque_nm FROM readings WHERE \"timestamp\" > TIMESTAMP '2024-01-15 00:00:00'",
)
_sql(
    "target_kind",
    "SELECT id, CASE WHEN predicted_failure_type IS NULL THEN 'binary' ELSE 'multiclass' END AS target, "
    f"'{C.BINARY_MODEL}' AS model_name FROM readings",
)

# --- labels ---------------------------------------------------------------------------------

_sql(
    "failure_flags",
    "SELECT id, "
    + ", ".join(f"CAST({expression} AS INTEGER) AS {flag}" for flag, expression in FLAGS.items())
    + ", CAST(0 AS INTEGER) AS rnf FROM readings",
)
_sql("failure_type", "SELECT id, failure_type FROM labelled", LABELLED)
_sql(
    "label_encode",
    f"SELECT id, CAST({_class_index('failure_type')} AS INTEGER) AS class_index FROM labelled",
    LABELLED,
)
_sql("label_decode", "SELECT id, nullif(predicted_type, 'none') AS failure_type FROM labelled", LABELLED)
_sql(
    "failures_by_cause",
    f"""SELECT {FAILURE_TYPE} AS failure_type, machine_type, count(*) AS readings,
      CAST(sum(injected_failure) AS BIGINT) AS failures, round(avg({WATTS} / {_d(1000)}), 6) AS avg_power_kw,
      round(max(torque_nm * tool_wear_minutes), 6) AS max_stress
    FROM dirty WHERE {VALID} GROUP BY 1, 2""",
    DIRTY,
)

# --- etl --------------------------------------------------------------------------------------


def _layout(source: str, start: str = "0") -> str:
    """Training layout of the rows of ``source``, keys following ``start``."""
    flags = ", ".join(f'CAST({FLAGS[f]} AS INTEGER) AS "{f.upper()}"' for f in ("twf", "hdf", "pwf", "osf"))
    return f"""
    SELECT CAST({start} + row_number() OVER (ORDER BY id) AS BIGINT) AS "UDI",
      concat(machine_type, CAST({C.PRODUCT_BASE} + row_number() OVER (ORDER BY id) AS VARCHAR)) AS "Product ID",
      machine_type AS "Type",
      round_even(air_temperature_kelvin, 1) AS "Air temperature [K]",
      round_even(process_temperature_kelvin, 1) AS "Process temperature [K]",
      CAST(trunc(rotational_speed_rpm) AS INTEGER) AS "Rotational speed [rpm]",
      round_even(torque_nm, 1) AS "Torque [Nm]",
      CAST(trunc(tool_wear_minutes) AS INTEGER) AS "Tool wear [min]",
      injected_failure AS "Machine failure", {flags}, CAST(0 AS INTEGER) AS "RNF"
    FROM {source}"""


SPLIT = """
older AS (SELECT * FROM readings WHERE id < (SELECT cut FROM middle)),
newer AS (SELECT * FROM readings WHERE id >= (SELECT cut FROM middle))
"""
BATCH = f"batch AS ({_layout('newer', '(SELECT count(*) FROM older)')})"
EXISTING = f"existing AS ({_layout('older')})"
WHOLE = f"existing AS ({_layout('readings')})"

_sql(
    "rename_contract",
    "SELECT \"UDI\", \"Product ID\", "
    + ", ".join(f'"{original}" AS {snake}' for original, snake in C.AI4I_TO_SNAKE.items())
    + f" FROM ({_layout('readings')})",
)
_sql(
    "next_udi",
    "SELECT count(*) AS existing_rows, max(\"UDI\") AS last_udi, max(\"UDI\") + 1 AS starting_udi FROM existing",
    WHOLE,
)
_sql(
    "sequence_udi",
    "SELECT id, CAST((SELECT count(*) FROM older) + row_number() OVER (ORDER BY id) AS BIGINT) AS udi FROM newer",
    SPLIT,
)
_sql(
    "product_id",
    f"SELECT id, concat(machine_type, CAST({C.PRODUCT_BASE} + row_number() OVER (ORDER BY id) AS VARCHAR)) "
    "AS product_id FROM readings",
)
_sql("export_layout", "SELECT * FROM batch", SPLIT, BATCH)
_sql(
    "export_summary",
    "SELECT count(*) AS rows, round(avg(\"Machine failure\"), 9) AS failure_rate, "
    + ", ".join(f'CAST(sum("{f}") AS BIGINT) AS {f.lower()}_count' for f in ("TWF", "HDF", "PWF", "OSF"))
    + ", "
    + ", ".join(
        f'round(CAST(sum("{f}") AS DOUBLE) / count(*), 9) AS {f.lower()}_share' for f in ("TWF", "HDF", "PWF", "OSF")
    )
    + ', min("UDI") AS first_udi, max("UDI") AS last_udi FROM batch',
    SPLIT,
    BATCH,
)
_sql("export_preview", 'SELECT * FROM batch ORDER BY "UDI" LIMIT 3', SPLIT, BATCH)
_sql("append_union", "SELECT * FROM existing UNION ALL SELECT * FROM batch", SPLIT, EXISTING, BATCH)
_sql(
    "purge_anti",
    "SELECT id, \"timestamp\", machine_id FROM readings WHERE id NOT IN (SELECT id FROM older)",
    SPLIT,
)
_sql("training_window", f'SELECT * FROM ({_layout("readings")}) ORDER BY "UDI" DESC LIMIT 5000')
_sql(
    "newest_readings",
    f'SELECT id, "timestamp", machine_id, {SENSORS} FROM readings ORDER BY "timestamp" DESC, id DESC LIMIT 2500',
)
# The layout stores whole rpm and minutes; the features are computed from the stored values.
_BASELINE_FEATURES = f"""SELECT type, air_temperature_kelvin, process_temperature_kelvin,
      CAST(rotational_speed_rpm AS INTEGER) AS rotational_speed_rpm, torque_nm,
      CAST(tool_wear_minutes AS INTEGER) AS tool_wear_minutes,
      {WATTS} / {_d(1000)} AS power_kw, {GAP} AS temp_diff_kelvin,
      torque_nm * tool_wear_minutes AS mechanical_stress
    FROM (SELECT "Type" AS type, "Air temperature [K]" AS air_temperature_kelvin,
        "Process temperature [K]" AS process_temperature_kelvin,
        CAST("Rotational speed [rpm]" AS DOUBLE) AS rotational_speed_rpm, "Torque [Nm]" AS torque_nm,
        CAST("Tool wear [min]" AS DOUBLE) AS tool_wear_minutes FROM existing)"""
_sql("baseline_csv", _BASELINE_FEATURES, WHOLE)
_sql(
    "baseline_sensor_rows",
    'SELECT "Type", "Air temperature [K]", "Process temperature [K]", "Rotational speed [rpm]", "Torque [Nm]" '
    "FROM existing",
    WHOLE,
)
_sql(
    "readings_scan",
    f"""SELECT id, "timestamp", reading_number, machine_id, machine_type, {NUMERIC}, predicted_failure,
      predicted_failure_type, failure_probability, injected_failure, mode,
      CASE WHEN predicted_failure_type IS NULL THEN 'binary' ELSE 'multiclass' END AS target, effective_failure_rate
    FROM readings WHERE "timestamp" > TIMESTAMP '2024-01-10 12:00:00'""",
)

# --- drift ----------------------------------------------------------------------------------------


def _long(columns: list[str], source: str, is_ref: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS feature, CAST({c} AS DOUBLE) AS value, {is_ref} AS is_ref FROM {source}"
        for c in columns
    )


def _ecdf(long: str, by: str = "feature") -> str:
    """CTEs from (feature, value, is_ref) rows to running counts and per-feature statistics."""
    return f"""
long AS ({long}),
counts AS (
  SELECT {by}, value, CAST(sum(CASE WHEN is_ref THEN 1 ELSE 0 END) AS BIGINT) AS n_ref,
    CAST(sum(CASE WHEN is_ref THEN 0 ELSE 1 END) AS BIGINT) AS n_cur
  FROM long WHERE value IS NOT NULL GROUP BY {by}, value
),
ecdf AS (
  SELECT *, CAST(sum(n_ref) OVER up AS BIGINT) AS cum_ref, CAST(sum(n_cur) OVER up AS BIGINT) AS cum_cur,
    CAST(sum(n_ref) OVER (PARTITION BY {by}) AS DOUBLE) AS t_ref,
    CAST(sum(n_cur) OVER (PARTITION BY {by}) AS DOUBLE) AS t_cur,
    lead(value) OVER (PARTITION BY {by} ORDER BY value) AS next_value
  FROM counts WINDOW up AS (PARTITION BY {by} ORDER BY value)
),
spread AS (SELECT {by}, stddev_pop(value) FILTER (WHERE is_ref) AS std_ref FROM long GROUP BY {by}),
num_stats AS (
  SELECT {", ".join("e." + k.strip() for k in by.split(","))}, count(*) AS n_values,
    CAST(sum(n_ref) AS BIGINT) AS n_ref, CAST(sum(n_cur) AS BIGINT) AS n_cur,
    max(abs(cum_ref / t_ref - cum_cur / t_cur)) AS ks,
    sum(abs(cum_ref / t_ref - cum_cur / t_cur) * coalesce(next_value - value, 0))
      / greatest(any_value(s.std_ref), {_d(C.WASSERSTEIN_NORM_FLOOR)}) AS wasserstein,
    {_js("n_ref / t_ref", "n_cur / t_cur")} AS js
  FROM ecdf e JOIN spread s USING ({by}) GROUP BY ALL
)"""


def _js(p: str, q: str) -> str:
    """Jensen-Shannon distance, natural logarithm."""
    middle = f"(({p} + {q}) / 2)"

    def side(share: str) -> str:
        return f"CASE WHEN {share} > 0 THEN ({share}) * ln(({share}) / {middle}) ELSE 0 END"

    return f"sqrt(greatest(sum(({side(p)} + {side(q)}) / 2), 0))"


def _cat_stats(columns: list[str], source: str, is_ref: str, by: str = "", extra: str = "") -> str:
    rows = " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS feature, CAST({c} AS VARCHAR) AS category, {is_ref} AS is_ref FROM {source}"
        for c in columns
    )
    expected = "(n_ref / t_ref * t_cur)"
    return f"""
cat_long AS ({rows}),
cat_counts AS (
  SELECT {by}feature, category, CAST(sum(CASE WHEN is_ref THEN 1 ELSE 0 END) AS BIGINT) AS n_ref,
    CAST(sum(CASE WHEN is_ref THEN 0 ELSE 1 END) AS BIGINT) AS n_cur
  FROM cat_long WHERE category IS NOT NULL GROUP BY ALL
),
cat_shares AS (
  SELECT *, CAST(sum(n_ref) OVER (PARTITION BY {by}feature) AS DOUBLE) AS t_ref,
    CAST(sum(n_cur) OVER (PARTITION BY {by}feature) AS DOUBLE) AS t_cur
  FROM cat_counts
),
cat_stats AS (
  SELECT {by}feature, count(*) AS n_values, CAST(sum(n_ref) AS BIGINT) AS n_ref,
    CAST(sum(n_cur) AS BIGINT) AS n_cur, {_js("n_ref / t_ref", "n_cur / t_cur")} AS js,
    sum((n_cur - {expected}) * (n_cur - {expected}) / {expected}) AS chi2
  FROM cat_shares GROUP BY ALL
)"""


_IS_REF = "id < (SELECT cut FROM middle)"
_PAIR = _ecdf(_long(C.NUMERIC_FEATURES, "readings", _IS_REF))
_TYPE = _cat_stats(["type"], "(SELECT *, machine_type AS type FROM readings)", _IS_REF)

_N = "(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur))"
_KS_P = f"""CASE WHEN {_N} * ks * ks < {_d(0.04)} THEN {_d(1)} ELSE least(greatest(list_sum(list_transform(
  range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp({_d(-2)} * k * k * {_N} * ks * ks)
)), {_d(0)}), {_d(1)}) END"""
# The reference size decides the kind of test. Numeric features here have more than five
# values; small references only meet categories with three levels (2 degrees of freedom).
_SMALL = f"n_ref <= {C.SMALL_REFERENCE}"
_VERDICTS = f"""
verdicts AS (
  SELECT *, CASE WHEN method LIKE '%distance%' THEN value > threshold ELSE value < threshold END AS drifted
  FROM (SELECT *, CASE WHEN method LIKE '%distance%' THEN {_d(C.DISTANCE_THRESHOLD)}
      ELSE {_d(C.P_VALUE_THRESHOLD)} END AS threshold
    FROM (
      SELECT feature, CASE WHEN {_SMALL} THEN 'K-S p_value' ELSE 'Wasserstein distance (normed)' END AS method,
        CASE WHEN {_SMALL} THEN {_KS_P} ELSE wasserstein END AS value, n_ref, n_cur
      FROM num_stats
      UNION ALL
      SELECT feature, CASE WHEN {_SMALL} THEN 'chi-square p_value' ELSE 'Jensen-Shannon distance' END,
        CASE WHEN {_SMALL} THEN exp(-chi2 / 2) ELSE js END, n_ref, n_cur
      FROM cat_stats))
)"""

_sql("ecdf_pair", "SELECT feature, value, n_ref, n_cur, cum_ref, cum_cur FROM ecdf", _PAIR)
_sql("ks_drift", f"SELECT feature, round(ks, 9) AS ks, round({_KS_P}, 9) AS p_value FROM num_stats", _PAIR)
_sql("wasserstein_drift", "SELECT feature, round(wasserstein, 9) AS wasserstein FROM num_stats", _PAIR)
_CATS = _cat_stats(
    ["machine_type", "event_type"],
    "(SELECT r.*, e.event_type FROM readings r JOIN events e ON e.event_id = r.id)",
    _IS_REF,
)
# Upper tails in closed form: 2 degrees of freedom for three types, 4 for five event types.
_sql(
    "chi2_drift",
    "SELECT feature, round(chi2, 9) AS chi2, round(exp(-chi2 / 2) * CASE n_values WHEN 3 THEN 1 "
    "WHEN 5 THEN 1 + chi2 / 2 END, 9) AS p_value FROM cat_stats",
    _CATS,
)
_sql("js_drift", "SELECT feature, round(js, 9) AS js FROM cat_stats", _CATS)
_sql(
    "drift_by_column",
    "SELECT feature, method, round(value, 9) AS value, threshold, drifted, n_ref, n_cur FROM verdicts",
    _PAIR,
    _TYPE,
    _VERDICTS,
)
_sql(
    "drift_verdict",
    f"""SELECT CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS drifted_columns,
      count(*) AS total_columns, round(avg(CASE WHEN drifted THEN 1 ELSE 0 END), 9) AS drift_share,
      avg(CASE WHEN drifted THEN 1 ELSE 0 END) >= {_d(C.DRIFT_SHARE_THRESHOLD)} AS drift_detected,
      max(n_cur) < {C.MIN_SAMPLE} AS low_sample FROM verdicts""",
    _PAIR,
    _TYPE,
    _VERDICTS,
)
_UNTIDY = f"""
untidy AS (
  SELECT * REPLACE (
    CASE WHEN id % 41 = 0 OR id % 43 = 0 THEN NULL ELSE torque_nm END AS torque_nm,
    CASE WHEN id % 37 = 0 OR id % 47 = 0 THEN NULL ELSE rotational_speed_rpm END AS rotational_speed_rpm,
    CASE WHEN {_IS_REF} THEN power_kw END AS power_kw)
  FROM readings
)"""
_sql(
    "drift_dirty",
    """SELECT feature, method, CASE WHEN n_ref > 0 AND n_cur > 0 THEN round(value, 9) END AS value, threshold,
      n_ref > 0 AND n_cur > 0 AND drifted AS drifted, n_ref, n_cur FROM verdicts""",
    _UNTIDY,
    _ecdf(_long(C.NUMERIC_FEATURES, "untidy", _IS_REF)),
    _TYPE,
    _VERDICTS,
)
_BOTH = f"""
both_sides AS (
  SELECT *, true AS is_ref FROM ({_BASELINE_FEATURES})
  UNION ALL BY NAME
  SELECT machine_type AS type, {NUMERIC}, false AS is_ref FROM newer
)"""
_sql(
    "drift_report",
    "SELECT feature, method, round(value, 9) AS value, threshold, drifted, n_ref, n_cur FROM verdicts",
    SPLIT,
    EXISTING,
    _BOTH,
    _ecdf(_long(C.NUMERIC_FEATURES, "both_sides", "is_ref")),
    _cat_stats(["type"], "both_sides", "is_ref"),
    _VERDICTS,
)
_B = C.HISTOGRAM_BINS
_sql(
    "drift_histogram",
    f"""SELECT feature, bin, round(low + bin * ((high - low) / {_d(_B)}), 6) AS bin_start,
      round(low + (bin + 1) * ((high - low) / {_d(_B)}), 6) AS bin_end,
      CAST(sum(CASE WHEN is_ref THEN 1 ELSE 0 END) AS BIGINT) AS n_ref,
      CAST(sum(CASE WHEN is_ref THEN 0 ELSE 1 END) AS BIGINT) AS n_cur
    FROM (SELECT *, least(CAST(floor((value - low) / (high - low) * {_B}) AS BIGINT), {_B - 1}) AS bin
      FROM (SELECT *, min(value) OVER (PARTITION BY feature) AS low, max(value) OVER (PARTITION BY feature) AS high
        FROM long))
    GROUP BY feature, bin, low, high""",
    _PAIR,
)
_sql(
    "column_summary",
    """SELECT l.feature, l.rows, l.nulls, l.distinct_values, l.mean, l.std, l.min, l.max,
      round(q.p25, 6) AS p25, round(q.p50, 6) AS p50, round(q.p75, 6) AS p75
    FROM (SELECT feature, count(value) AS rows, count(*) - count(value) AS nulls,
        count(DISTINCT value) AS distinct_values, round(avg(value), 6) AS mean,
        round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max
      FROM long GROUP BY feature) l
    JOIN (SELECT feature, min(value) FILTER (WHERE rank >= ceil(n * CAST(0.25 AS DOUBLE))) AS p25,
        min(value) FILTER (WHERE rank >= ceil(n * CAST(0.5 AS DOUBLE))) AS p50,
        min(value) FILTER (WHERE rank >= ceil(n * CAST(0.75 AS DOUBLE))) AS p75
      FROM (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS rank,
          count(*) OVER (PARTITION BY feature) AS n FROM long WHERE value IS NOT NULL)
      GROUP BY feature) q ON q.feature = l.feature""",
    DIRTY,
    f"long AS ({_long(C.NUMERIC_FEATURES, 'dirty', 'true')})",
)
_sql(
    "category_summary",
    """SELECT feature, count(category) AS rows, count(*) - count(category) AS nulls,
      count(DISTINCT category) AS distinct_values,
      (SELECT c.category FROM long c WHERE c.feature = long.feature AND c.category IS NOT NULL
        GROUP BY c.category ORDER BY count(*) DESC, c.category LIMIT 1) AS most_frequent
    FROM long GROUP BY feature""",
    "long AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS category FROM readings"
        for c in ("machine_type", "mode", "predicted_failure_type")
    )
    + ")",
)
_SHIPPED = "l_shipdate < TIMESTAMP '1998-01-01'"
_sql(
    "drift_lineitem",
    "SELECT feature, method, round(value, 9) AS value, threshold, drifted, n_ref, n_cur FROM verdicts",
    _ecdf(_long(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem", _SHIPPED)),
    _cat_stats(["l_returnflag", "l_linestatus"], "lineitem", _SHIPPED),
    _VERDICTS,
)

# Drift of every day against the first: one pair per (day, feature), the reference repeated.
_DAYS = """
dated AS (SELECT *, machine_type AS type, CAST("timestamp" AS DATE) AS day FROM readings),
first_day AS (SELECT min(day) AS day FROM dated),
days AS (SELECT DISTINCT day FROM dated WHERE day > (SELECT day FROM first_day)),
paired AS (
  SELECT * , false AS is_ref FROM dated WHERE day > (SELECT day FROM first_day)
  UNION ALL
  SELECT d.* REPLACE (days.day AS day), true AS is_ref FROM dated d, days
  WHERE d.day = (SELECT day FROM first_day)
)"""
_CHI2_P = "exp(-chi2 / 2)"
_sql(
    "drift_by_day",
    f"""SELECT day, feature, method, round(value, 9) AS value,
      CASE WHEN method LIKE '%distance%' THEN value > {_d(C.DISTANCE_THRESHOLD)}
        ELSE value < {_d(C.P_VALUE_THRESHOLD)} END AS drifted, n_ref, n_cur
    FROM (
      SELECT day, feature, n_ref, n_cur,
        CASE WHEN {_SMALL} THEN 'K-S p_value' ELSE 'Wasserstein distance (normed)' END AS method,
        CASE WHEN {_SMALL} THEN {_KS_P} ELSE wasserstein END AS value FROM num_stats
      UNION ALL
      SELECT day, feature, n_ref, n_cur,
        CASE WHEN {_SMALL} THEN 'chi-square p_value' ELSE 'Jensen-Shannon distance' END AS method,
        CASE WHEN {_SMALL} THEN {_CHI2_P} ELSE js END AS value FROM cat_stats)""",
    _DAYS,
    _ecdf(_long(C.NUMERIC_FEATURES, "paired", "is_ref", "day, "), "day, feature"),
    _cat_stats(["type"], "paired", "is_ref", "day, ", "day, "),
)

# --- training data -----------------------------------------------------------------------------------


def _prefix(salt: str) -> str:
    return f"substr(md5(concat(CAST(id AS VARCHAR), '-{salt}')), 1, 4)"


_IS_TEST = f"{_prefix(str(C.SEED))} < '3333'"
TRAIN = f"train AS (SELECT * FROM labelled WHERE NOT ({_IS_TEST}))"
_sql(
    "stratified_split",
    f"SELECT id, injected_failure, CAST(CASE WHEN {_IS_TEST} THEN 1 ELSE 0 END AS INTEGER) AS is_test FROM readings",
)
_FOLD = _prefix(f"cv-{C.SEED}")
_sql(
    "stratified_folds",
    f"SELECT id, CAST(CASE WHEN {_FOLD} < '3333' THEN 0 WHEN {_FOLD} < '6666' THEN 1 WHEN {_FOLD} < '9999' THEN 2 "
    f"WHEN {_FOLD} < 'cccc' THEN 3 ELSE 4 END AS INTEGER) AS fold FROM train",
    LABELLED,
    TRAIN,
)
_sql(
    "imbalance_ratio",
    """SELECT count(*) FILTER (WHERE injected_failure = 0) AS negatives,
      count(*) FILTER (WHERE injected_failure = 1) AS positives,
      round(CAST(count(*) FILTER (WHERE injected_failure = 0) AS DOUBLE)
        / count(*) FILTER (WHERE injected_failure = 1), 9) AS imbalance_ratio FROM train""",
    LABELLED,
    TRAIN,
)
_sql(
    "class_weights",
    """SELECT failure_type AS label, count(*) AS n, round(CAST((SELECT count(*) FROM train) AS DOUBLE)
      / ((SELECT count(DISTINCT failure_type) FROM train) * count(*)), 9) AS weight FROM train GROUP BY failure_type""",
    LABELLED,
    TRAIN,
)
_sql("type_vocabulary", "SELECT DISTINCT machine_type AS type FROM readings")

# --- metrics -----------------------------------------------------------------------------------------------


def _safe(numerator: str, denominator: str) -> str:
    return f"CASE WHEN ({denominator}) = 0 THEN {_d(0)} ELSE CAST({numerator} AS DOUBLE) / ({denominator}) END"


def _binary(group: str = "") -> str:
    """Counts and scores of the stored binary prediction, per ``group``."""
    select = f"{group}, " if group else ""
    by = f" GROUP BY {group}" if group else ""

    def count(label: int, prediction: int) -> str:
        return f"count(*) FILTER (WHERE injected_failure = {label} AND predicted_failure = {prediction})"

    return f"""SELECT *, round({_safe('tp', 'tp + fp')}, 9) AS precision, round({_safe('tp', 'tp + fn')}, 9) AS recall,
      round({_safe('2 * tp', '2 * tp + fp + fn')}, 9) AS f1
    FROM (SELECT {select}{count(1, 1)} AS tp, {count(0, 1)} AS fp, {count(1, 0)} AS fn, {count(0, 0)} AS tn
      FROM {{source}}{by})"""


CLASSES = f"""
classes AS (SELECT DISTINCT failure_type AS class FROM labelled UNION SELECT predicted_type FROM labelled),
class_counts AS (
  SELECT class, (SELECT count(*) FROM labelled WHERE failure_type = class AND predicted_type = class) AS tp,
    (SELECT count(*) FROM labelled WHERE failure_type = class) AS actual,
    (SELECT count(*) FROM labelled WHERE predicted_type = class) AS predicted FROM classes
),
per_class AS (
  SELECT *, {_safe('tp', 'predicted')} AS precision, {_safe('tp', 'actual')} AS recall,
    {_safe('2 * tp', 'predicted + actual')} AS f1 FROM class_counts
)"""
_sql(
    "confusion",
    "SELECT failure_type AS label, predicted_type AS prediction, count(*) AS n FROM labelled GROUP BY 1, 2",
    LABELLED,
)
_sql("binary_scores", _binary().format(source="readings"))
_sql("prediction_quality", _binary("machine_type, mode").format(source="readings"))
_sql(
    "class_scores",
    "SELECT class, tp, actual, predicted, round(precision, 9) AS precision, round(recall, 9) AS recall, "
    "round(f1, 9) AS f1 FROM per_class",
    LABELLED,
    CLASSES,
)
_sql(
    "macro_scores",
    "SELECT count(*) AS classes, round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall, "
    "round(avg(f1), 9) AS f1 FROM per_class",
    LABELLED,
    CLASSES,
)
# Mann-Whitney form: mean rank of the positives, ties at their average rank.
_sql(
    "roc_auc",
    """SELECT round((sum(CASE WHEN injected_failure = 1 THEN rank END)
        - CAST(any_value(pos) AS DOUBLE) * (any_value(pos) + 1) / 2)
      / (CAST(any_value(pos) AS DOUBLE) * (any_value(n) - any_value(pos))), 9) AS roc_auc
    FROM (SELECT injected_failure, count(*) OVER () AS n, sum(injected_failure) OVER () AS pos,
        rank() OVER (ORDER BY failure_probability)
          + (count(*) OVER (PARTITION BY failure_probability) - 1) / CAST(2 AS DOUBLE) AS rank FROM readings)""",
)
_sql(
    "brier_binary",
    "SELECT round(avg((failure_probability - injected_failure) * (failure_probability - injected_failure)), 9) "
    "AS brier_score FROM readings",
)


def _share(k: int) -> str:
    name = C.FAILURE_CLASSES[k]
    return f"(CASE WHEN predicted_type = '{name}' THEN failure_probability ELSE (1 - failure_probability) / {_d(4)} END)"


_SQUARES = " + ".join(
    f"power({_share(k)} - CASE WHEN failure_type = '{name}' THEN 1 ELSE 0 END, 2)"
    for k, name in enumerate(C.FAILURE_CLASSES)
)
_sql("brier_multiclass", f"SELECT round(avg({_SQUARES}) / 2, 9) AS brier_score FROM labelled", LABELLED)
_SHARES = [_share(k) for k in range(len(C.FAILURE_CLASSES))]
_sql(
    "argmax_prediction",
    "SELECT id, CAST(CASE "
    + " ".join(f"WHEN {share} = greatest({', '.join(_SHARES)}) THEN {k}" for k, share in enumerate(_SHARES))
    + " END AS INTEGER) AS prediction FROM labelled",
    LABELLED,
)
_sql(
    "calibration_bins",
    """SELECT least(CAST(floor(failure_probability * 10) AS BIGINT), 9) AS bin, count(*) AS rows,
      round(avg(failure_probability), 9) AS mean_predicted, round(avg(injected_failure), 9) AS observed_rate
    FROM readings GROUP BY 1""",
)
_F1 = _safe(
    "2 * count(*) FILTER (WHERE injected_failure = 1 AND predicted_failure = 1 AND {side})",
    "count(*) FILTER (WHERE injected_failure = 1 AND {side}) + count(*) FILTER (WHERE predicted_failure = 1 AND {side})",
)
_sql(
    "overfit_delta",
    f"""SELECT mode, round(a, 9) AS f1_train, round(b, 9) AS f1_test, round(a - b, 9) AS overfit_delta,
      a - b > {_d(C.OVERFIT_WARNING)} AS overfit_warning
    FROM (SELECT mode, {_F1.replace("{side}", f"NOT ({_IS_TEST})")} AS a, {_F1.replace("{side}", _IS_TEST)} AS b
      FROM readings GROUP BY mode)""",
)


def _averaged() -> str:
    def raw(k: int, fold: int) -> str:
        slope, intercept = SIGMOIDS[fold]
        return f"(1 / (1 + exp({_d(slope)} * {_share(k)} + {_d(intercept)})))"

    n = len(C.FAILURE_CLASSES)
    columns = []
    for k, name in enumerate(C.FAILURE_CLASSES):
        folds = [f"{raw(k, f)} / ({' + '.join(raw(j, f) for j in range(n))})" for f in range(len(SIGMOIDS))]
        columns.append(f"round(({' + '.join(folds)}) / {_d(len(SIGMOIDS))}, 9) AS p_{name}")
    return "SELECT id, " + ", ".join(columns) + " FROM labelled"


_sql("calibrate_average", _averaged(), LABELLED)

# --- promotion --------------------------------------------------------------------------------------------

ORACLES["promotion_report"] = f"""
WITH versions AS (
  SELECT concat(CASE WHEN o_custkey % 2 = 0 THEN 'binary-' ELSE 'multiclass-' END, CAST(o_custkey AS VARCHAR)) AS model,
    o_custkey, o_orderkey AS number,
    CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 11 <> 0 THEN round(o_totalprice / {_d(500000)}, 4) END AS metric
  FROM orders
),
candidates AS (
  SELECT model, number, metric FROM versions
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY number DESC) = 1
),
production AS (
  SELECT model, number, metric FROM versions WHERE o_custkey % 3 <> 0
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY number) = 1
),
judged AS (
  SELECT c.model, CAST(c.number AS VARCHAR) AS candidate_version, c.metric AS new_metric,
    CAST(p.number AS VARCHAR) AS production_version, p.metric AS production_metric,
    CASE WHEN c.model LIKE '%binary%' THEN {_d(C.BINARY_F1_FLOOR)} ELSE {_d(C.MULTICLASS_F1_FLOOR)} END AS floor
  FROM candidates c LEFT JOIN production p USING (model)
),
gated AS (
  SELECT *, CASE WHEN production_metric IS NULL THEN true ELSE new_metric > production_metric END AS gate_improvement,
    new_metric >= floor AS gate_floor,
    production_version IS NOT NULL AND production_metric IS NULL AS production_metric_missing
  FROM judged
)
SELECT *, CASE WHEN new_metric IS NULL THEN 'NO METRIC' WHEN NOT (gate_improvement AND gate_floor) THEN 'NOT PROMOTED'
    ELSE 'WOULD PROMOTE' END AS decision,
  CASE WHEN gate_improvement AND gate_floor THEN round(new_metric - production_metric, 9) END AS delta
FROM gated"""

# --- scoring ------------------------------------------------------------------------------------------------

_RESPONSE = "predicted_failure AS machine_failure, round_even(failure_probability, 4) AS failure_probability"
_MODEL = f"'{C.BINARY_MODEL}' AS model_name, '1' AS model_version"
_sql("gate_detail_rules", f"SELECT id, {_RESPONSE}, predicted_failure_type AS failure_type, {_MODEL} FROM readings")
_sql("gate_only", f"SELECT id, {_RESPONSE}, CAST(NULL AS VARCHAR) AS failure_type, {_MODEL} FROM readings")
_sql(
    "batch_explode",
    f"SELECT id // 8 AS request_id, CAST(id % 8 AS INTEGER) AS position, {_RESPONSE}, "
    "predicted_failure_type AS failure_type FROM readings",
)
_sql(
    "batch_totals",
    "SELECT id // 8 AS request_id, count(*) AS total_readings, "
    "CAST(sum(predicted_failure) AS BIGINT) AS total_failures_predicted FROM readings GROUP BY 1",
)
_sql(
    "alert_level",
    f"SELECT id, CASE WHEN failure_probability >= {_d(C.ALERT_HIGH)} THEN 'shutdown' "
    f"WHEN failure_probability >= {_d(C.ALERT_LOW)} THEN 'inspect' ELSE 'ok' END AS alert FROM readings",
)

# --- scenario -----------------------------------------------------------------------------------------------

_BASE, _PEAK = _d(C.BASE_FAILURE_RATE), _d(C.RAMP_PEAK_RATE)
_LENGTH = "(SELECT count(*) FROM events)"
_sql(
    "failure_rate_schedule",
    f"""SELECT reading_number, {_BASE} AS flat,
      {_BASE} + CAST(reading_number - 1 AS DOUBLE) / CAST(greatest({_LENGTH} - 1, 1) AS DOUBLE) * ({_PEAK} - {_BASE})
        AS ramp,
      CASE WHEN reading_number - 1 >= {_LENGTH} // 2 THEN {_d(C.SPIKE_RATE)} ELSE {_BASE} END AS step,
      {_BASE} AS other, effective_failure_rate FROM readings""",
)


def _hash(salt: str) -> str:
    return f"CAST(concat('0x', substr(md5(concat(CAST(id AS VARCHAR), '-{salt}')), 1, 8)) AS BIGINT)"


_sql(
    "fault_shift",
    f"""SELECT id, CAST(chosen AS INTEGER) AS chosen, round_even(air_temperature_kelvin, 1) AS air_temperature_kelvin,
      round_even(CASE WHEN chosen AND narrow THEN air_temperature_kelvin + {_d(C.FAULT_GAP_MEAN)}
        ELSE process_temperature_kelvin END, 1) AS process_temperature_kelvin,
      CAST(round_even(CASE WHEN chosen AND NOT narrow
        THEN greatest({_d(C.FAULT_RPM_FLOOR)}, rotational_speed_rpm + {_d(C.FAULT_RPM_SHIFT)})
        ELSE rotational_speed_rpm END, 0) AS INTEGER) AS rotational_speed_rpm,
      round_even(CASE WHEN chosen AND NOT narrow THEN greatest({_d(0)}, torque_nm + {_d(C.FAULT_TORQUE_ADD)})
        ELSE torque_nm END, 1) AS torque_nm,
      CAST(round_even(tool_wear_minutes, 0) AS INTEGER) AS tool_wear_minutes
    FROM (SELECT *, {_hash('fault')} / {_d(4294967296)} < effective_failure_rate AS chosen,
        {_hash('hdf')} / {_d(4294967296)} < {_d(C.HDF_FRACTION)} AS narrow FROM readings)""",
)
_sql(
    "bootstrap_rows",
    f"""SELECT d.id, d.row_index, b.machine_type, b.air_temperature_kelvin, b.process_temperature_kelvin,
      b.rotational_speed_rpm, b.torque_nm
    FROM (SELECT id, {_hash('draw')} % (SELECT count(*) FROM older) + 1 AS row_index FROM newer) d
    JOIN (SELECT *, row_number() OVER (ORDER BY id) AS row_index FROM older) b ON b.row_index = d.row_index""",
    SPLIT,
)
_sql(
    "tool_life_cycles",
    """SELECT machine_id, cycle, min(tool_wear_minutes) AS min_wear, max(tool_wear_minutes) AS max_wear,
      count(*) AS readings, CAST(sum(injected_failure) AS BIGINT) AS failures,
      min("timestamp") AS first_seen, max("timestamp") AS last_seen
    FROM (SELECT *, CAST(sum(reset) OVER (PARTITION BY machine_id ORDER BY id) AS BIGINT) AS cycle
      FROM (SELECT *, CASE WHEN tool_wear_minutes < lag(tool_wear_minutes) OVER (PARTITION BY machine_id ORDER BY id)
          THEN 1 ELSE 0 END AS reset FROM readings))
    GROUP BY machine_id, cycle""",
)

# --- streaming: a stream over the whole table ends where the batch form does --------------------------------

_sql(
    "stream_score",
    f"""SELECT id, predicted_failure, CASE WHEN predicted_failure = 1 THEN nullif({PHYSICS_TYPE}, 'none') END
        AS predicted_failure_type, failure_probability,
      CASE WHEN predicted_failure = 1 AND {PHYSICS_TYPE} <> 'none' THEN 'multiclass' ELSE 'binary' END AS target
    FROM dirty WHERE {VALID}""",
    DIRTY,
)
# Same test as drift_by_column on all readings of the newer half, alert share 0.2.
_NEWEST = f"""
newest AS (
  SELECT *, machine_type AS type, false AS is_ref
  FROM readings WHERE id >= (SELECT cut FROM middle)
  UNION ALL SELECT *, machine_type AS type, true AS is_ref FROM readings WHERE id < (SELECT cut FROM middle)
)"""
_sql(
    "stream_drift",
    """SELECT drift_detected, drift_detected AS retrain_triggered,
      CAST((SELECT count(*) FROM readings WHERE id >= (SELECT cut FROM middle)) AS BIGINT) AS exported_rows
    FROM (SELECT avg(CASE WHEN drifted THEN 1 ELSE 0 END) >= CAST(0.2 AS DOUBLE) AS drift_detected FROM verdicts)""",
    _NEWEST,
    _ecdf(_long(C.NUMERIC_FEATURES, "newest", "is_ref")),
    _cat_stats(["type"], "newest", "is_ref"),
    _VERDICTS,
)
ORACLES["stream_window_drift"] = (
    f"SELECT * FROM ({ORACLES['drift_by_day']}) WHERE day < (SELECT max(CAST(ts AS DATE)) FROM events)"
)
_sql(
    "stream_tool_state",
    """SELECT machine_id, CAST(sum(reset) AS BIGINT) AS tool_changes, max_by(tool_wear_minutes, id) AS current_wear,
      count(*) AS readings
    FROM (SELECT *, CASE WHEN tool_wear_minutes < lag(tool_wear_minutes) OVER (PARTITION BY machine_id ORDER BY id)
        THEN 1 ELSE 0 END AS reset FROM readings)
    GROUP BY machine_id""",
)
