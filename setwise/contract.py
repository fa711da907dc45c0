"""The data contract: file header, channel names, table schemas, model settings."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------------
# They must match the recorder firmware and existing tables, so they are spelled out.

# Header of a session file, in file order.
HEADER = (
    "timevector,ax1,ay1,az1,gx1,gy1,gz1,qx1,qy1,qz1,qw1,wax1,way1,waz1,wgx1,wgy1,wgz1,temp1,"
    "ax2,ay2,az2,gx2,gy2,gz2,qx2,qy2,qz2,qw2,wax2,way2,waz2,wgx2,wgy2,wgz2,temp2,"
    "button1,button2,button3"
)

# The same columns in the tables, in file order: wrist sensor (_ws), chest strap (_cs), buttons.
TABLE_NAMES = (
    "time_vector,accelX_ws,accelY_ws,accelZ_ws,gyroX_ws,gyroY_ws,gyroZ_ws,"
    "quatX_ws,quatY_ws,quatZ_ws,quatW_ws,worldAccelX_ws,worldAccelY_ws,worldAccelZ_ws,"
    "worldGyroX_ws,worldGyroY_ws,worldGyroZ_ws,temperature_ws,"
    "accelX_cs,accelY_cs,accelZ_cs,gyroX_cs,gyroY_cs,gyroZ_cs,"
    "quatX_cs,quatY_cs,quatZ_cs,quatW_cs,worldAccelX_cs,worldAccelY_cs,worldAccelZ_cs,"
    "worldGyroX_cs,worldGyroY_cs,worldGyroZ_cs,temperature_cs,"
    "trough,peak,start_end_excercise"
)

MISSING_TEXT = "NULL"
SUPPORTED_DEVICE = "_MPU6500_"
STAMP_PATTERN = r"(\d{8}-\d{6}_\d{6})"
STAMP_FORMAT = "yyyyMMdd-HHmmss_SSSSSS"
DEVICE_PATTERN = r"(MPU\d{4})"
WALL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CLASS_NAMES = {7: "Squat", 5: "Deadlift"}
UNKNOWN = "Unknown"
SMOOTHING_ROWS = 50
WRIST_OFFSET = (500, 0, 0)
BATCH_BYTES = 10 * 1024**3
GOLD_ROWS_PER_FILE = 1_000_000

TREE_PARAMS = {"maxBins": 24, "maxDepth": 16, "minInfoGain": 0.05, "minInstancesPerNode": 4, "impurity": "entropy"}
FOREST_PARAMS = {"numTrees": 50, "maxDepth": 15, "maxBins": 20, "minInfoGain": 0.001, "impurity": "entropy"}
SPLIT_SEED = 42
TRAIN_PERCENT = 80
FOLDS = 5
RUN_NAME = "Current_models"
# Names that stored models know: their working columns, the labels, and the models themselves.
FEATURE_COLUMN, SCALED_COLUMN = "features", "scaledFeatures"
SET_LABEL, UP_LABEL, DOWN_LABEL = "start_end_excercise_id", "concentric", "eccentric"
SET_MODEL, UP_MODEL, DOWN_MODEL = "start-end-excercise-id-model", "concentric-model", "eccentric-model"
# ----------------------------------------------------------------------------------

RAW = HEADER.split(",")
CHANNELS = TABLE_NAMES.split(",")
BUTTON_CHANNELS = CHANNELS[-3:]
SENSOR_CHANNELS = CHANNELS[1:-3]
RENAMES = dict(zip(RAW, CHANNELS)) | {"filename": "filename"}

RAW_AXES = [c for c in SENSOR_CHANNELS if c.startswith(("accel", "gyro"))]
"""Raw sensor axes: an exact zero means the sensor did not answer."""

FEATURES = sorted(["time_vector", *SENSOR_CHANNELS])
"""Model inputs in alphabetical order."""


def _fields(names, kind) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names]


SESSION_FILE = T.StructType(_fields(RAW[:-3], T.DoubleType()) + _fields(RAW[-3:], T.IntegerType()))

BRONZE = T.StructType([*SESSION_FILE.fields, *_fields(["_rescued_data", "filename"], T.StringType())])

_PROVENANCE = [
    T.StructField("filename", T.StringType(), True),
    T.StructField("measure_date", T.TimestampType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("mpuVersion", T.StringType(), True),
]

PRODUCTION = T.StructType(_fields(["time_vector", *SENSOR_CHANNELS], T.DoubleType()) + _PROVENANCE)

SUMMARY = T.StructType(
    [
        T.StructField("filename", T.StringType(), True),
        T.StructField("measure_date", T.TimestampType(), True),
        T.StructField("excercise", T.StringType(), True),
        T.StructField("sets", T.LongType(), True),
        T.StructField("reps", T.DoubleType(), True),
        *_fields([f"{how}_{span}_time" for how in ("total", "avg") for span in ("concentric", "eccentric", "rest")], T.DoubleType()),
        *_fields(["count_concentric_times", "count_eccentric_times"], T.LongType()),
    ]
)

TRAINING = T.StructType(
    _fields(["time_vector", "relative_time", *SENSOR_CHANNELS], T.DoubleType())
    + _fields(["concentric", "eccentric", "start_end_excercise", "start_end_excercise_id"], T.IntegerType())
    + _PROVENANCE
    + _fields(["excercise_id"], T.IntegerType())
)
