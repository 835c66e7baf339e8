"""Registered queries: rolling features, scalers, windows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, LOW_VARIANCE_SENSORS, OP_SETTINGS, ROLLING_SIZES, ROLLING_STATS, SENSORS, UNIT
from cyclewise.functions.arrays import forecast_input, forecast_target, patches, pick_features
from cyclewise.operators import features, scalers
from cyclewise.operators.features import rolling_name
from cyclewise.plans import fixtures
from cyclewise.plans.registry import (
    SUPPLIER_PANEL,
    USER_PANEL,
    VECTOR_PANEL,
    query,
    rounded,
    rounded_all,
    with_,
)
from cyclewise.session import shared_dir
from cyclewise.sources.stores import load_scaler, save_scaler

P2 = list(fixtures.SUPPLIER_SENSORS)
_DIGITS = {"sensor_2": 4, "sensor_3": 2, "sensor_4": 6, "sensor_7": 6}
#: no mean of 30 two-digit numbers lies halfway between two values of this precision
_SUMMARY_DIGITS = {"sensor_2": 3, "sensor_3": 3, "sensor_4": 5, "sensor_7": 5}


def _rolling_sql(sensors, sizes=ROLLING_SIZES):
    out = []
    for size in sizes:
        for stat in ROLLING_STATS:
            fn = "avg" if stat == "mean" else "stddev_samp"
            for c in sensors:
                out.append(
                    f"coalesce({fn}({c}) OVER (PARTITION BY unit_id ORDER BY time_cycles "
                    f"ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW), 0.0) "
                    f"AS {rolling_name(c, stat, size)}"
                )
    return ", ".join(out)


ROLLED_NAMES = [
    rolling_name("sensor_2", stat, size) for size in ROLLING_SIZES for stat in ROLLING_STATS
]
ROLLED_SQL = f"rolled AS (SELECT *, {_rolling_sql(['sensor_2'])} FROM user_panel)"
_FEATURES = ["sensor_2", *ROLLED_NAMES]


def round_list(names, digits=6):
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in names)


@query(
    with_(
        USER_PANEL,
        ROLLED_SQL,
        select=f"SELECT unit_id, time_cycles, {round_list(ROLLED_NAMES)} FROM rolled",
    )
)
def rolling_features(spark, sf_dir):
    rows, layout = fixtures.user_readings(spark, sf_dir)
    rolled = features.add_rolling_features(rows, ["sensor_2"], position=CYCLE, layout=layout)
    return rounded_all(rolled.select(UNIT, CYCLE, *ROLLED_NAMES))


_GAP_NAMES = [rolling_name(c, s, 5) for s in ROLLING_STATS for c in ("sensor_4", "sensor_7")]


@query(
    with_(
        SUPPLIER_PANEL,
        """gapped AS (SELECT unit_id, 3 * time_cycles AS time_cycles,
             CASE WHEN sensor_4 <> 0 THEN sensor_4 END AS sensor_4,
             CASE WHEN sensor_7 <> 0 THEN sensor_7 END AS sensor_7 FROM supplier_panel)""",
        f"rolled AS (SELECT *, {_rolling_sql(['sensor_4', 'sensor_7'], [5])} FROM gapped)",
        select=f"""SELECT unit_id, time_cycles, coalesce(sensor_4, 0.0) AS sensor_4,
        coalesce(sensor_7, 0.0) AS sensor_7, {round_list(_GAP_NAMES)} FROM rolled""",
    )
)
def rolling_with_missing(spark, sf_dir):
    """Missing values are skipped by the statistics and 0 in the output; cycles have gaps."""
    panel, layout = fixtures.supplier_panel(spark, sf_dir)
    rows = panel.select(
        UNIT,
        (F.col(CYCLE) * 3).alias(CYCLE),
        *[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in ("sensor_4", "sensor_7")],
    )
    return rounded_all(features.add_rolling_features(rows, ["sensor_4", "sensor_7"], [5], layout=layout))


@query(
    with_(
        SUPPLIER_PANEL,
        select="SELECT "
        + ", ".join(
            f"round({f}({c}), 2) + 0.0 AS {c}_{f}" for c in P2 for f in ("min", "max")
        )
        + " FROM supplier_panel",
    )
)
def minmax_fit(spark, sf_dir):
    return rounded_all(scalers.min_max_table(fixtures.supplier_panel(spark, sf_dir)[0], P2), 2)


@query(
    with_(
        SUPPLIER_PANEL,
        f"fitted AS (SELECT {', '.join(f'min({c}) AS {c}_lo, max({c}) AS {c}_hi' for c in P2)} "
        "FROM supplier_panel)",
        select="SELECT unit_id, time_cycles, "
        + ", ".join(
            f"CASE WHEN {c}_hi = {c}_lo THEN 0.0 ELSE "
            f"round(({c} - {c}_lo) / ({c}_hi - {c}_lo), 6) + 0.0 END AS {c}"
            for c in P2
        )
        + " FROM supplier_panel, fitted",
    )
)
def minmax_apply(spark, sf_dir):
    rows = fixtures.supplier_panel(spark, sf_dir)[0].select(UNIT, CYCLE, *P2)
    return rounded_all(scalers.transform_features(rows, scalers.fit_scaler(rows, "min_max")))


@query(
    with_(
        SUPPLIER_PANEL,
        select="SELECT "
        + ", ".join(
            f"round({fn}({c}), {_DIGITS[c]}) + 0.0 AS {c}_{n}"
            for c in P2
            for n, fn in (("mean", "avg"), ("std", "stddev_samp"))
        )
        + " FROM supplier_panel",
    )
)
def zscore_fit(spark, sf_dir):
    table = scalers.mean_std_table(fixtures.supplier_panel(spark, sf_dir)[0], P2)
    special = {f"{c}_{n}": _DIGITS[c] for c in P2 for n in ("mean", "std")}
    return rounded_all(table, 6, **special)


@query(
    with_(
        SUPPLIER_PANEL,
        "fitted AS (SELECT "
        + ", ".join(f"avg({c}) AS {c}_mu, stddev_samp({c}) AS {c}_sd" for c in P2)
        + " FROM supplier_panel)",
        select="SELECT unit_id, time_cycles, "
        + ", ".join(
            f"CASE WHEN {c}_sd = 0 THEN 0.0 ELSE "
            f"round(({c} - {c}_mu) / {c}_sd, 6) + 0.0 END AS {c}"
            for c in P2
        )
        + " FROM supplier_panel, fitted",
    )
)
def zscore_apply(spark, sf_dir):
    rows = fixtures.supplier_panel(spark, sf_dir)[0].select(UNIT, CYCLE, *P2)
    return rounded_all(scalers.transform_features(rows, scalers.fit_scaler(rows, "standard")))


_FRAME = "(PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


@query(
    with_(
        USER_PANEL,
        f"""w AS (SELECT unit_id, time_cycles, is_anomaly AS label, count(*) OVER f AS n_steps,
             first_value(sensor_2) OVER f AS first_step, sensor_2 AS last_step,
             sum(sensor_2) OVER f AS total FROM user_panel WINDOW f AS {_FRAME})""",
        select="""SELECT unit_id, time_cycles, label, CAST(n_steps AS INTEGER) AS n_steps,
        first_step, last_step, round(total, 4) + 0.0 AS total FROM w WHERE n_steps = 30""",
    )
)
def sliding_windows(spark, sf_dir):
    rows, layout = fixtures.user_readings(spark, sf_dir)
    built = features.sliding_windows(rows, ["sensor_2"], position=CYCLE, layout=layout)
    flat = F.flatten("window")
    return built.select(
        UNIT,
        CYCLE,
        "label",
        F.size("window").alias("n_steps"),
        F.get(flat, F.lit(0)).alias("first_step"),
        F.element_at(flat, -1).alias("last_step"),
        rounded(F.aggregate(flat, F.lit(0.0), lambda a, v: a + v), 4).alias("total"),
    )


@query(
    with_(
        SUPPLIER_PANEL,
        "w AS (SELECT unit_id, time_cycles, is_anomaly AS label, count(*) OVER f AS n_steps, "
        + ", ".join(f"avg({c}) OVER f AS {c}_mean, stddev_pop({c}) OVER f AS {c}_std" for c in P2)
        + f" FROM supplier_panel WINDOW f AS {_FRAME})",
        select="SELECT unit_id, time_cycles, label, "
        + ", ".join(
            f"round({c}_{n}, {_SUMMARY_DIGITS[c]}) + 0.0 AS {c}_{n}" for c in P2 for n in ("mean", "std")
        )
        + " FROM w WHERE n_steps = 30",
    )
)
def window_summary(spark, sf_dir):
    rows, layout = fixtures.supplier_panel(spark, sf_dir)
    special = {f"{c}_{n}": _SUMMARY_DIGITS[c] for c in P2 for n in ("mean", "std")}
    return rounded_all(features.window_summary(rows, P2, position=CYCLE, layout=layout), 6, **special)


@query(
    with_(
        USER_PANEL,
        f"""w AS (SELECT unit_id, time_cycles, count(*) OVER f AS n_steps,
             first_value(sensor_2) OVER f AS input_first,
             lag(sensor_2, 10) OVER u AS input_last, lag(sensor_2, 9) OVER u AS target_first,
             sensor_2 AS target_last FROM user_panel
             WINDOW f AS {_FRAME}, u AS (PARTITION BY unit_id ORDER BY time_cycles))""",
        select="""SELECT unit_id, time_cycles, 20 AS n_input, 10 AS n_target, input_first,
        input_last, target_first, target_last FROM w WHERE n_steps = 30""",
    )
)
def forecast_pairs(spark, sf_dir):
    rows, layout = fixtures.user_readings(spark, sf_dir)
    built = features.sliding_windows(rows, ["sensor_2"], position=CYCLE, layout=layout)
    pairs = built.select(
        UNIT,
        CYCLE,
        forecast_input(F.col("window"), 30, 10).alias("x"),
        forecast_target(F.col("window"), 30, 10).alias("y"),
    )
    return pairs.select(
        UNIT,
        CYCLE,
        F.size("x").alias("n_input"),
        F.size("y").alias("n_target"),
        *[
            F.get(F.element_at(side, place), F.lit(0)).alias(name)
            for side, place, name in (
                ("x", 1, "input_first"),
                ("x", -1, "input_last"),
                ("y", 1, "target_first"),
                ("y", -1, "target_last"),
            )
        ],
    )


@query(
    with_(
        USER_PANEL,
        f"""w AS (SELECT unit_id, time_cycles, count(*) OVER f AS n_steps,
             list(sensor_2) OVER f AS s FROM user_panel WINDOW f AS {_FRAME})""",
        select="""SELECT unit_id, time_cycles, CAST(patch AS INTEGER) AS patch,
        s[patch * 4 + 1] AS first_value, s[patch * 4 + 8] AS last_value
        FROM (SELECT *, unnest(range(0, 6)) AS patch FROM w WHERE n_steps = 30) p""",
    ),
    name="patches",
)
def window_patches(spark, sf_dir):
    rows, layout = fixtures.user_readings(spark, sf_dir)
    built = features.sliding_windows(rows, ["sensor_2"], position=CYCLE, layout=layout)
    cut = built.select(
        UNIT, CYCLE, F.posexplode(patches(F.flatten("window"), 30)).alias("patch", "values")
    )
    return cut.select(
        UNIT,
        CYCLE,
        "patch",
        F.element_at("values", 1).alias("first_value"),
        F.element_at("values", -1).alias("last_value"),
    )


_SCALE_SQL = (
    "fitted AS (SELECT "
    + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in _FEATURES)
    + " FROM rolled), scaled AS (SELECT unit_id, time_cycles, rul, is_anomaly, "
    + ", ".join(f"({c} - {c}_lo) / ({c}_hi - {c}_lo) AS {c}" for c in _FEATURES)
    + " FROM rolled, fitted)"
)


@query(
    with_(
        USER_PANEL,
        ROLLED_SQL,
        _SCALE_SQL,
        select="SELECT unit_id, count(*) AS n_rows, round(avg(is_anomaly), 6) + 0.0 "
        "AS anomaly_rate, "
        + ", ".join(f"round(avg({c}), 6) + 0.0 AS {c}" for c in _FEATURES)
        + " FROM scaled GROUP BY unit_id",
    )
)
def flagship_features(spark, sf_dir):
    """Panel, labels, rolling features, scaling, and the mean features of every unit."""
    rows, layout = fixtures.user_readings(spark, sf_dir)
    engineered = features.engineer(rows, position=CYCLE, layout=layout)
    scaled = scalers.transform_features(engineered, scalers.fit_scaler(engineered))
    return scaled.groupBy(UNIT).agg(
        F.count(F.lit(1)).alias("n_rows"),
        rounded(F.avg("is_anomaly")).alias("anomaly_rate"),
        *[rounded(F.avg(c)).alias(c) for c in _FEATURES],
    )


@query(
    with_(
        USER_PANEL,
        ROLLED_SQL,
        _SCALE_SQL,
        "w AS (SELECT unit_id, time_cycles, is_anomaly AS label, count(*) OVER f AS n_steps, "
        + ", ".join(f"sum({c}) OVER f AS {c}" for c in _FEATURES)
        + f" FROM scaled WINDOW f AS {_FRAME})",
        select="SELECT unit_id, time_cycles, label, "
        + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _FEATURES)
        + " FROM w WHERE n_steps = 30",
    )
)
def feature_windows(spark, sf_dir):
    """The whole feature pipeline up to scaled windows; features summed over the steps."""
    rows, layout = fixtures.user_readings(spark, sf_dir)
    scaler = scalers.fit_scaler(features.engineer(rows, position=CYCLE, layout=layout))
    built = features.build_features(rows, scaler, position=CYCLE, layout=layout)
    return built.select(
        UNIT,
        CYCLE,
        "label",
        *[rounded(_step_sum(i)).alias(c) for i, c in enumerate(_FEATURES)],
    )


def _step_sum(i: int) -> Column:
    """Sum of one feature over the steps of the window."""
    return F.aggregate("window", F.lit(0.0), lambda a, step: a + F.get(step, F.lit(i)))


_KEPT = [c for c in SENSORS if c not in LOW_VARIANCE_SENSORS]
_ROLLED_101 = [
    f"avg({c}) OVER w{n}" if stat == "mean" else f"coalesce(stddev_samp({c}) OVER w{n}, 0.0)"
    for n in ROLLING_SIZES
    for stat in ROLLING_STATS
    for c in _KEPT
]


@query(
    with_(
        VECTOR_PANEL,
        f"""rolled AS (
          SELECT *, {' + '.join([*OP_SETTINGS, *_KEPT])} AS raw_sum, {' + '.join(_ROLLED_101)} AS rolled_sum
          FROM vector_panel WINDOW {', '.join(
              f"w{n} AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
              for n in ROLLING_SIZES)})""",
        select="""SELECT unit_id, count(*) AS n_rows, 101 AS n_features, 17 AS n_raw,
        round(sum(raw_sum), 4) + 0.0 AS raw_sum, round(sum(raw_sum + rolled_sum), 3) + 0.0 AS all_sum
        FROM rolled GROUP BY unit_id""",
    )
)
def channel_reduction(spark, sf_dir):
    """Full panel: the sums of all 101 features, and of the 17 raw channels among them."""
    rows, layout = fixtures.vector_panel(spark, sf_dir)
    engineered = features.engineer(rows, position=CYCLE, layout=layout)
    names = scalers.feature_columns(engineered)
    raw = scalers.raw_feature_columns(names)
    whole = engineered.select(UNIT, *[sum((F.col(c) for c in of), F.lit(0.0)).alias(n) for n, of in (("raw", raw), ("every", names))])
    return whole.groupBy(UNIT).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(names)).alias("n_features"),
        F.lit(len(raw)).alias("n_raw"),
        rounded(F.sum("raw"), 4).alias("raw_sum"),
        rounded(F.sum("every"), 3).alias("all_sum"),
    )


@query(
    with_(
        SUPPLIER_PANEL,
        f"fitted AS (SELECT {', '.join(f'min({c}) AS {c}_lo, max({c}) AS {c}_hi' for c in P2)} "
        "FROM supplier_panel)",
        "w AS (SELECT unit_id, time_cycles, count(*) OVER f AS n_steps, "
        + ", ".join(
            f"avg(({c} - {c}_lo) / ({c}_hi - {c}_lo)) OVER f AS {c}" for c in ("sensor_3", "sensor_7")
        )
        + " FROM supplier_panel, fitted WINDOW f AS (PARTITION BY unit_id ORDER BY time_cycles "
        "ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))",
        select="""SELECT unit_id, time_cycles, 10 AS n_steps, 2 AS n_channels,
        round(sensor_3, 6) + 0.0 AS sensor_3, round(sensor_7, 6) + 0.0 AS sensor_7
        FROM w WHERE n_steps = 10""",
    )
)
def window_normalise(spark, sf_dir):
    """Raw windows scaled with the fitted scaler, then reduced to two channels."""
    rows, layout = fixtures.supplier_panel(spark, sf_dir)
    scaler = scalers.fit_scaler(rows, columns=P2)
    built = features.sliding_windows(rows, P2, 10, position=CYCLE, layout=layout)
    scaled = scalers.transform_window(F.col("window"), scaler, P2)
    picked = built.select(UNIT, CYCLE, pick_features(scaled, [1, 3]).alias("window"))

    return picked.select(
        UNIT,
        CYCLE,
        F.size("window").alias("n_steps"),
        F.size(F.get("window", F.lit(0))).alias("n_channels"),
        rounded(_step_sum(0) / F.size("window")).alias("sensor_3"),
        rounded(_step_sum(1) / F.size("window")).alias("sensor_7"),
    )


@query(
    with_(
        USER_PANEL,
        select="""SELECT unit_id, count(*) AS n_normal FROM user_panel
        WHERE is_anomaly = 0 AND time_cycles >= 30 GROUP BY unit_id""",
    )
)
def normal_windows(spark, sf_dir):
    rows, layout = fixtures.user_readings(spark, sf_dir)
    built = features.window_summary(rows, ["sensor_2"], position=CYCLE, layout=layout)
    return built.filter("label = 0").groupBy(UNIT).agg(F.count(F.lit(1)).alias("n_normal"))


@query(
    with_(
        SUPPLIER_PANEL,
        "fitted AS (SELECT min(sensor_3) AS lo, max(sensor_3) AS hi, avg(sensor_2) AS mu, "
        "stddev_samp(sensor_2) AS sd FROM supplier_panel)",
        select="""SELECT unit_id, time_cycles, round((sensor_3 - lo) / (hi - lo), 6) + 0.0 AS scaled,
        round((sensor_2 - mu) / sd, 6) + 0.0 AS standardised FROM supplier_panel, fitted""",
    )
)
def scaler_store(spark, sf_dir):
    """Two scalers fitted, written as documents, read back and applied."""
    rows = fixtures.supplier_panel(spark, sf_dir)[0]
    base = f"{shared_dir(spark)}/scalers-{uuid.uuid4().hex}"
    save_scaler(spark, scalers.fit_scaler(rows, "min_max", ["sensor_3"]), f"{base}/a")
    save_scaler(spark, scalers.fit_scaler(rows, "standard", ["sensor_2"]), f"{base}/b")
    low_high, mean_std = load_scaler(spark, f"{base}/a"), load_scaler(spark, f"{base}/b")
    return rows.select(
        UNIT,
        CYCLE,
        rounded(low_high.expression(F.col("sensor_3"), "sensor_3")).alias("scaled"),
        rounded(mean_std.expression(F.col("sensor_2"), "sensor_2")).alias("standardised"),
    )
