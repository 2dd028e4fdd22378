"""The registered queries as SQL over the given tables."""

from pointmill.plans.queries import (
    COMMITS, DATASETS, INTAKE_FILES, INTAKE_PER_BATCH, LINE_ORDER, NETWORK, NETWORK_CLASSES, NETWORK_INPUTS, NEW_VOXEL, RATE_WINDOW_SECONDS, SMALL_FILES,
)
from pointmill.plans.views import point_columns, raw_columns
from pointmill.schema import VOXEL_ML_FEATURES


POINT_COLUMNS = point_columns("round({} * 100)")
RAW_COLUMNS = raw_columns("round({} * 100)")


def _view(name: str, columns: dict[str, str]) -> str:
    body = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"{name} AS (SELECT {body} FROM lineitem)"


POINTS = _view("points", POINT_COLUMNS)
RAW = _view("raw", RAW_COLUMNS)
CLEAN = f"{POINTS}, cleaned AS (SELECT * FROM points WHERE label <> 0)"

ALL_COLUMNS = 'x, y, z, red, green, blue, intensity, "timestamp", scan_angle, label'


def _keys(size: str = "1.0") -> str:
    divide = "" if size == "1.0" else f" / {size}"
    return ", ".join(f"CAST(round({a}{divide}) AS INT) AS voxel_{a}" for a in "xyz")


def _majority(source: str, out: str) -> str:
    return f"""{out} AS (
        SELECT voxel_x, voxel_y, voxel_z, label AS majority_label FROM (
            SELECT voxel_x, voxel_y, voxel_z, label, row_number() OVER (
                PARTITION BY voxel_x, voxel_y, voxel_z ORDER BY n DESC, label) AS place
            FROM (SELECT {_keys()}, label, count(*) AS n FROM {source} GROUP BY ALL))
        WHERE place = 1)"""


VOXELS = f"""{CLEAN}, {_majority("cleaned", "winners")},
    means AS (
        SELECT {_keys()}, avg(intensity) AS avg_intensity, count(*) AS point_count,
            CAST(trunc(avg(red)) AS INT) AS avg_red, CAST(trunc(avg(green)) AS INT) AS avg_green,
            CAST(trunc(avg(blue)) AS INT) AS avg_blue
        FROM cleaned GROUP BY ALL),
    voxels AS (
        SELECT voxel_x, voxel_y, voxel_z, avg_intensity, majority_label, point_count, avg_red, avg_green, avg_blue
        FROM means JOIN winners USING (voxel_x, voxel_y, voxel_z))"""


def _features(source: str, out: str) -> str:
    return f"""{out} AS (
        SELECT concat_ws('_', voxel_x, voxel_y, voxel_z) AS voxel_id, * EXCLUDE (voxel_x, voxel_y, voxel_z) FROM (
            SELECT {_keys()}, avg(x) AS mean_x, avg(y) AS mean_y, avg(z) AS mean_z, avg(intensity) AS mean_intensity,
                avg(red + green + blue) / 3 AS mean_brightness, avg(blue) / 255 AS mean_blue_norm,
                avg(green) / 255 AS mean_green_norm, avg(red) / 255 AS mean_red_norm
            FROM {source} GROUP BY ALL))"""


FEATURES = f"{POINTS}, {_features('points', 'features')}"

# Each version of the table, worked out from the one before it.
_FEATURE_COLUMNS = (
    "voxel_id, mean_x, mean_y, mean_z, mean_intensity, mean_brightness, "
    "mean_blue_norm, mean_green_norm, mean_red_norm"
)
_NEW_ROW = ", ".join(
    f"CAST({e.split(' AS ')[0]} AS DOUBLE) AS {e.split(' AS ')[1]}" if "voxel_id" not in e else e
    for e in NEW_VOXEL.split(", ")
)
VERSIONS = f"""{FEATURES},
    v1 AS (SELECT {_FEATURE_COLUMNS} FROM features),
    boosted AS (
        SELECT * REPLACE (mean_intensity * CAST(1.10 AS DOUBLE) AS mean_intensity) FROM (
            SELECT * FROM v1 WHERE mean_intensity > 15 ORDER BY voxel_id LIMIT 50)),
    v2 AS (SELECT * FROM v1 UNION ALL SELECT * FROM boosted),
    v3 AS (SELECT * FROM v2 WHERE NOT coalesce(mean_intensity < 5, false)),
    v4 AS (SELECT * REPLACE (
        CASE WHEN mean_z > 2 THEN mean_brightness * CAST(1.05 AS DOUBLE) ELSE mean_brightness END AS mean_brightness)
        FROM v3),
    v5 AS (SELECT * FROM v4 UNION ALL SELECT {_NEW_ROW})"""

_COUNTS = """counts(version, added, deleted) AS (
        SELECT 1, (SELECT count(*) FROM v1), 0
        UNION ALL SELECT 2, (SELECT count(*) FROM boosted), 0
        UNION ALL SELECT 3, 0, (SELECT count(*) FROM v2) - (SELECT count(*) FROM v3)
        UNION ALL SELECT 4, (SELECT count(*) FROM v3 WHERE mean_z > 2), (SELECT count(*) FROM v3 WHERE mean_z > 2)
        UNION ALL SELECT 5, 1, 0)"""
_COMMITS = "commits(version, operation, committed_at) AS (VALUES {})".format(
    ", ".join(f"({v}, '{op}', TIMESTAMP '{at}')" for v, op, at in COMMITS)
)
LOG = f"""{VERSIONS}, {_COUNTS}, {_COMMITS},
    log AS (
        SELECT CAST(version AS INT) AS version, CAST(lag(version) OVER (ORDER BY version) AS INT) AS parent,
            operation, committed_at, CAST(added AS BIGINT) AS added, CAST(deleted AS BIGINT) AS deleted,
            CAST(sum(added - deleted) OVER (ORDER BY version) AS BIGINT) AS total
        FROM counts JOIN commits USING (version))"""

METRICS = """metrics AS (
        SELECT CAST(user_id % 4 AS INT) AS instance, event_type AS mode, event_id, ts AS sample_ts,
            CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (
                PARTITION BY user_id % 4, event_type ORDER BY ts, event_id) % 500000 AS BIGINT) AS counter,
            value AS gauge
        FROM events)"""
RATES = f"""{METRICS},
    samples AS (
        SELECT instance, mode, sample_ts, arg_max(counter, event_id) AS counter
        FROM metrics GROUP BY instance, mode, sample_ts),
    steps AS (
        SELECT *, CASE WHEN counter < before THEN counter ELSE counter - before END AS gain FROM (
            SELECT *, lag(counter) OVER (PARTITION BY instance, mode ORDER BY sample_ts) AS before FROM samples)),
    spans AS (
        SELECT instance, mode, sample_ts, counter,
            sum(gain) OVER w - coalesce(first_value(gain) OVER w, 0) AS increase,
            epoch_us(sample_ts) - epoch_us(min(sample_ts) OVER w) AS elapsed
        FROM steps WINDOW w AS (PARTITION BY instance, mode ORDER BY sample_ts
            RANGE BETWEEN INTERVAL {RATE_WINDOW_SECONDS} SECONDS PRECEDING AND CURRENT ROW)),
    rates AS (
        SELECT instance, mode, sample_ts, counter,
            CASE WHEN elapsed > 0 THEN CAST(increase AS DOUBLE) / (CAST(elapsed AS DOUBLE) / 1e6) END AS rate
        FROM spans)"""

PREDICTIONS = f"""{VOXELS},
    predictions AS (
        SELECT majority_label AS label, CAST(CAST(floor(avg_intensity) AS BIGINT) % 6 + 1 AS INT) AS predicted
        FROM voxels)"""

SPLIT = f"""{VOXELS},
    marked AS (
        SELECT *, CAST(((((voxel_x::BIGINT * 73856093 + voxel_y::BIGINT * 19349663 + voxel_z::BIGINT * 83492791)
            % 2147483647 + 2147483647) % 2147483647 * 48271) % 2147483647) % 10 < 2 AS INT) AS is_test
        FROM voxels)"""


def _scaled(source: str, fit: str) -> str:
    moments = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in VOXEL_ML_FEATURES)
    columns = ", ".join(
        f"round(CASE WHEN {c}_s > 0 THEN ({c} - {c}_m) / {c}_s ELSE 0 END, 6) AS {c}_scaled"
        for c in VOXEL_ML_FEATURES
    )
    return f"SELECT voxel_x, voxel_y, voxel_z, {columns} FROM {source}, (SELECT {moments} FROM {fit})"


def _summary(column: str) -> str:
    return f"min({column}) AS min_{column}, max({column}) AS max_{column}, avg({column}) AS avg_{column}"


def _network() -> str:
    """A CTE per layer; place and u count from 1."""
    inputs = ", ".join(f"CAST({c} AS DOUBLE) / {d}" for c, d in NETWORK_INPUTS.items())
    text = f"{VOXELS}, layer0 AS (SELECT voxel_x, voxel_y, voxel_z, majority_label, [{inputs}] AS v FROM voxels)"
    for k, (weights, bias) in enumerate(NETWORK, 1):
        total = f"list_sum(list_transform(range(1, {len(weights[0])} + 1), lambda i: ({weights})[u][i] * v[i])) + ({bias})[u]"
        unit = f"greatest(0, {total})" if k < len(NETWORK) else total
        text += f""",
    layer{k} AS (SELECT * REPLACE (list_transform(range(1, {len(weights)} + 1), lambda u: CAST({unit} AS DOUBLE)) AS v) FROM layer{k - 1})"""
    return f"""{text},
    powers AS (SELECT * REPLACE (list_transform(v, lambda x: exp(x - list_max(v))) AS v) FROM layer{len(NETWORK)}),
    scored AS (SELECT voxel_x, voxel_y, voxel_z, majority_label, list_transform(v, lambda x: x / list_sum(v)) AS p,
        CAST(({NETWORK_CLASSES})[list_position(v, list_max(v))] AS INT) AS predicted FROM powers)"""


_PROFILE_TYPES = {"red": "int", "green": "int", "blue": "int", "label": "int"}
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{_PROFILE_TYPES.get(c, "double")}' AS data_type, count(*) AS row_count,
        count("{c}") AS non_null, CAST(min("{c}") AS DOUBLE) AS min_value, CAST(max("{c}") AS DOUBLE) AS max_value
        FROM points"""
    for c in POINT_COLUMNS
)
_INDEX = """(SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INT) AS label_index
    FROM (SELECT DISTINCT label FROM cleaned))"""
_VOXEL_COLUMNS = "voxel_x, voxel_y, voxel_z"


def oracles() -> dict[str, str]:
    clean = f"WITH {CLEAN} SELECT {ALL_COLUMNS} FROM cleaned"
    all_points = f"WITH {POINTS} SELECT {ALL_COLUMNS} FROM points"
    normalized = f"""WITH {RAW} SELECT x, y, z, CAST(red AS INT) AS red, CAST(green AS INT) AS green,
        CAST(blue AS INT) AS blue, "scalar_Intensity" AS intensity, "scalar_GPSTime" AS "timestamp",
        "scalar_ScanAngleRank" AS scan_angle, CAST(trunc("scalar_Label") AS INT) AS label FROM raw"""
    voxel_table = f"WITH {VOXELS} SELECT * FROM voxels"
    feature_table = f"WITH {FEATURES} SELECT * FROM features"
    version = lambda v: f"WITH {VERSIONS} SELECT * FROM v{v}"
    return {
        "clean_points": clean,
        "normalize_points": normalized,
        "voxel_keys": f"WITH {POINTS} SELECT x, y, z, {_keys()}, label FROM points",
        "voxel_keys_half": f"WITH {POINTS} SELECT x, y, z, {_keys('0.5')}, label FROM points",
        "json_messages": all_points,
        "global_shift": f"""WITH {POINTS} SELECT {", ".join(
            f"{a} - (SELECT floor(min({a}) / 2.0) * 2.0 FROM points) AS {a}" for a in "xyz")}, label FROM points""",
        "voxelize": voxel_table,
        "majority_label": f"WITH {VOXELS} SELECT {_VOXEL_COLUMNS}, majority_label, point_count FROM voxels",
        "voxel_features": feature_table,
        "voxel_ml_features": f"WITH {VOXELS} SELECT {', '.join(VOXEL_ML_FEATURES)}, majority_label FROM voxels",
        "profile_points": f"WITH {POINTS} {_PROFILE}",
        "row_count": f"WITH {POINTS} SELECT count(*) AS row_count FROM points",
        "distinct_voxels": f"WITH {FEATURES} SELECT count(DISTINCT voxel_id) AS distinct_voxel_id FROM features",
        "intensity_stats": f"WITH {POINTS} SELECT {_summary('intensity')} FROM points",
        "height_stats": f"WITH {POINTS} SELECT {_summary('z')} FROM points",
        "high_intensity": f"""WITH {FEATURES} SELECT voxel_id, mean_x, mean_y, mean_z, mean_intensity
            FROM features WHERE mean_intensity > 20""",
        "height_band": f"""WITH {FEATURES} SELECT voxel_id, mean_z, mean_intensity
            FROM features WHERE mean_z >= -1 AND mean_z <= 2""",
        "height_band_count": f"""WITH {FEATURES} SELECT count(*) AS row_count
            FROM features WHERE mean_z >= -1 AND mean_z <= 2""",
        "top_voxels": f"WITH {FEATURES} SELECT * FROM features ORDER BY mean_intensity DESC, voxel_id LIMIT 10",
        "label_distribution": f"WITH {POINTS} SELECT label, count(*) AS row_count FROM points GROUP BY label",
        "json_roundtrip": all_points,
        "parquet_roundtrip": feature_table,
        "sql_on_files": "SELECT l_returnflag, count(*) AS total_rows FROM lineitem GROUP BY l_returnflag",
        "glob_scan": voxel_table,
        "file_inventory": " UNION ALL ".join(
            f"SELECT '{t}' AS dataset, CAST({n} AS BIGINT) AS files, count(*) AS row_count, CAST(1 AS BIGINT) AS skipped_files, TRUE AS all_sized FROM {t}"
            for t, n in DATASETS.items()
        ),
        "compact": f"WITH {VOXELS} SELECT *, {SMALL_FILES} AS files_before, TRUE AS fewer_files, TRUE AS within_limit FROM voxels",
        "partitioned_table": f"{voxel_table} WHERE majority_label IN (2, 3)",
        "partitioned_table_whole": voxel_table,
        "append_table": voxel_table,
        "ply_scan": normalized,
        "ply_scan_ascii": normalized,
        "ply_limit": normalized.replace("FROM lineitem", f"FROM (SELECT * FROM lineitem ORDER BY {', '.join(LINE_ORDER)} LIMIT 5000)", 1),
        "stream_clean": clean,
        "stream_restart": f"WITH {CLEAN} SELECT {ALL_COLUMNS}, unnest(['resumed', 'replayed']) AS run FROM cleaned",
        "stream_bounded": f"""WITH {CLEAN} SELECT CAST("timestamp" AS BIGINT) % {INTAKE_FILES} // {INTAKE_PER_BATCH} AS batch, count(*) AS row_count,
            CAST(sum(label) AS BIGINT) AS labels FROM cleaned GROUP BY 1""",
        "intake_counts": f"""WITH {CLEAN} SELECT (SELECT count(*) FROM points) + (SELECT count(*) FROM nation) AS records,
            (SELECT count(*) FROM nation) AS corrupt, count(*) AS kept, count(*) AS arrived FROM cleaned""",
        "class_names": f"""WITH {POINTS} SELECT label, n_name AS class_name, count(*) AS row_count
            FROM points LEFT JOIN nation ON label = n_nationkey GROUP BY label, n_name""",
        "label_overlay": f"""WITH {CLEAN}, {_majority("cleaned", "a")}, {_majority("points", "b")}
            SELECT {_VOXEL_COLUMNS}, a.majority_label AS label, b.majority_label AS predicted
            FROM a JOIN b USING ({_VOXEL_COLUMNS}) WHERE a.majority_label <> b.majority_label""",
        "accuracy": f"""WITH {PREDICTIONS} SELECT count(*) AS n, count(*) FILTER (label = predicted) AS correct,
            CAST(count(*) FILTER (label = predicted) AS DOUBLE) / count(*) AS accuracy FROM predictions""",
        "confusion": f"WITH {PREDICTIONS} SELECT label, predicted, count(*) AS n FROM predictions GROUP BY ALL",
        "class_report": f"""WITH {PREDICTIONS},
            classes AS (SELECT label AS c FROM predictions UNION SELECT predicted FROM predictions),
            tallies AS (
                SELECT c, count(*) FILTER (label = c) AS support, count(*) FILTER (predicted = c) AS found,
                    count(*) FILTER (label = c AND predicted = c) AS hits
                FROM classes, predictions GROUP BY c)
            SELECT c AS label, coalesce(hits / nullif(found, 0)::DOUBLE, 0) AS precision,
                coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall,
                coalesce(2 * hits / nullif(found + support, 0)::DOUBLE, 0) AS f1, support FROM tallies""",
        "version_current": version(5),
        "version_append": version(2),
        "version_delete": version(3),
        "version_update": version(4),
        "version_as_of": version(2),
        "version_as_of_ts": version(3),
        "version_as_of_saved": version(1),
        "version_append_saved": version(5),
        "version_history": f"WITH {LOG} SELECT committed_at AS made_current_at, version, parent, added FROM log",
        "version_replace": f"""WITH {VERSIONS}, cleaned AS (SELECT * FROM points WHERE label <> 0),
            {_features("cleaned", "replacement")}
            SELECT *, 1 AS valid_from, CASE WHEN mean_intensity < 5 THEN 3 WHEN mean_z > 2 THEN 4 ELSE 6 END AS valid_to
            FROM v1
            UNION ALL SELECT *, 2, CASE WHEN mean_intensity < 5 THEN 3 WHEN mean_z > 2 THEN 4 ELSE 6 END FROM boosted
            UNION ALL SELECT *, 4, 6 FROM v4 WHERE mean_z > 2
            UNION ALL SELECT *, 5, 6 FROM (SELECT {_NEW_ROW})
            UNION ALL SELECT {_FEATURE_COLUMNS}, 6, NULL FROM replacement""",
        "version_log": f"WITH {LOG} SELECT * FROM log",
        "version_bounds": f"""WITH {LOG} SELECT CASE WHEN version = 1 THEN 'first' ELSE 'latest' END AS bound, *
            FROM log WHERE version IN (1, 5)""",
        "version_count": f"WITH {LOG} SELECT count(*) AS row_count FROM log WHERE added + deleted > 0",
        "version_compare": f"""WITH {VERSIONS} SELECT (SELECT count(*) FROM v1) AS count_a,
            (SELECT count(*) FROM v5) AS count_b, (SELECT count(*) FROM v5) AS count_current""",
        "counter_rate": f"WITH {RATES} SELECT * FROM rates",
        "cpu_usage": f"""WITH {RATES} SELECT instance, round(100 - avg(rate) * 100, 6) AS cpu_usage
            FROM (SELECT * FROM rates WHERE mode = 'view'
                QUALIFY row_number() OVER (PARTITION BY instance ORDER BY sample_ts DESC) = 1)
            GROUP BY instance""",
        "latest_gauge": f"""WITH {METRICS} SELECT instance, mode, sample_ts, gauge FROM (
                SELECT *, row_number() OVER (PARTITION BY instance, mode ORDER BY sample_ts DESC, event_id DESC) AS place
                FROM metrics) WHERE place = 1""",
        "scale_features": f"WITH {VOXELS} {_scaled('voxels', 'voxels')}",
        "scale_features_train": f"WITH {SPLIT} {_scaled('marked', 'marked WHERE is_test = 0')}",
        "encode_labels": f"""WITH {VOXELS} SELECT {_VOXEL_COLUMNS}, majority_label, label_index
            FROM voxels JOIN {_INDEX} ON label = majority_label""",
        "one_hot": f"""WITH {VOXELS} SELECT {_VOXEL_COLUMNS}, {", ".join(
            f"CAST(label_index = {i} AS INT) AS class_{i}" for i in range(6))}
            FROM voxels JOIN {_INDEX} ON label = majority_label""",
        "split_voxels": f"WITH {SPLIT} SELECT {_VOXEL_COLUMNS}, is_test FROM marked",
        "classify_voxels": f"WITH {SPLIT} SELECT {_VOXEL_COLUMNS}, majority_label, TRUE AS known_label FROM marked WHERE is_test = 1",
        "model_quality": f"""WITH {SPLIT} SELECT count(*) AS n, TRUE AS accuracy_in_range, TRUE AS loss_in_range
            FROM marked WHERE is_test = 1""",
        "network_scores": f"""WITH {_network()} SELECT {_VOXEL_COLUMNS}, predicted, {", ".join(
            f"round(p[{k}], 6) AS p{c}" for k, c in enumerate(NETWORK_CLASSES, 1))} FROM scored""",
        "network_quality": f"""WITH {_network()} SELECT count(*) AS n, round(avg(CASE WHEN majority_label = predicted THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
            round(avg(-ln(greatest(coalesce(p[list_position({NETWORK_CLASSES}, majority_label)], 0), 1e-15::DOUBLE))), 6) AS log_loss FROM scored""",
        "model_reload": f"WITH {VOXELS} SELECT {_VOXEL_COLUMNS}, majority_label, TRUE AS alike FROM voxels",
        "log_loss": f"""WITH {PREDICTIONS} SELECT count(*) AS n, round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
            round(avg(-ln(CASE WHEN label = predicted THEN CAST(0.5 AS DOUBLE)
                WHEN label BETWEEN 1 AND 6 THEN CAST(0.1 AS DOUBLE) ELSE CAST(1e-15 AS DOUBLE) END)), 9) AS log_loss FROM predictions""",
    }
