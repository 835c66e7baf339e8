"""Names and defaults of the sensor-panel model."""

from __future__ import annotations

from pyspark.sql import types as T

UNIT = "unit_id"
CYCLE = "time_cycles"

OP_SETTINGS = [f"op_setting_{i}" for i in range(1, 4)]
SENSORS = [f"sensor_{i}" for i in range(1, 22)]
RAW_COLUMNS = [UNIT, CYCLE, *OP_SETTINGS, *SENSORS]
LABEL_COLUMNS = ["rul", "is_anomaly", "timestamp"]
METADATA = {UNIT, CYCLE, *LABEL_COLUMNS}

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in (UNIT, CYCLE)]
    + [T.StructField(c, T.DoubleType()) for c in [*OP_SETTINGS, *SENSORS]]
)

# They must equal the published pipeline's defaults for right results.
LOW_VARIANCE_SENSORS = [
    "sensor_1",
    "sensor_5",
    "sensor_6",
    "sensor_10",
    "sensor_16",
    "sensor_18",
    "sensor_19",
]
RUL_THRESHOLD = 30
WINDOW_SIZE = 30
ROLLING_SIZES = [5, 10, 20]
ROLLING_STATS = ["mean", "std"]
FORECAST_HORIZON = 10
PATCH_LENGTH = 8
PATCH_STRIDE = 4
LATENT_DIM = 32
TREES = 200
TREE_SAMPLE = 256
CONTAMINATION = 0.05
CONTAMINATION_GRID = [0.01, 0.02, 0.05, 0.08, 0.10, 0.15]
TEST_SIZE = 0.2
VALIDATION_SIZE = 0.1
SEED = 42
SEARCH_MIN = 0.01
SEARCH_MAX = 1.0
SEARCH_STEPS = 100
HISTOGRAM_BINS = 50
LATENCY_BOUNDS = [1, 2, 5, 10, 20, 50, 100, 200, 500, 1000]
SCORE_BOUNDS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
DRIFT_P_VALUE = 0.05
DRIFT_SHARE = 0.1
HISTORY_ROWS = 2000
EVENT_ROWS = 200
EVENT_LOG_ROWS = 50
MAX_SENSOR_ID = 64
MAX_MODEL_VERSION = 128

# Scale limits of this library.
#: A unit with more rows than this is split over several tasks.
HOT_ROWS = 250_000
#: At most this many units are split; the row limit rises with the data to keep it.
MAX_HOT_UNITS = 250_000
#: Ranges per row limit; sampled borders are uneven by less than this factor.
RANGE_MARGIN = 2
