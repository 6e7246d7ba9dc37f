"""Relation schemas, the feature list and the fixed values."""

from pyspark.sql import types as T

# --- fixed values: must equal the published method's, else features differ ---
EPS = 0.001
PAGE_WIDTH = 1024
MIN_PAGE_SIZE = 100
PAGE_MARGIN = 20
CHAR_MIN_HEIGHT, CHAR_MAX_HEIGHT = 5, 20
CHAR_MIN_WIDTH, CHAR_MAX_WIDTH = 2, 100
MAX_EROSIONS = 250
GAUSS_SIGMA = 0.95
GAUSS_THRESHOLDS = (120, 150, 180, 190)
MEDIAN_KERNELS = (3, 5)
ADAPTIVE_BLOCK, ADAPTIVE_C = 11, 2
ENTROPY_BINS = (2, 4, 8, 16, 32, 64, 128)
UNIFORMITY_BANDS = (1, 4, 16)
UNIFORMITY_CUT = 0.01
SCORE_BUCKETS = (0.25, 0.5, 0.75, 1.0)
TEST_SHARE, SPLIT_SEED = 0.2, 42
METRICS = ("R2", "MAE", "MSE", "PLCC", "SROCC")

FEATURES_BY_CATEGORY = {
    "cc": ["FS", "SSF", "TCF", "WSF", "SWS", "SW_1", "SW_2", "height_width_ratio",
           "characters_to_cc_ratio"],
    "morph": ["erosion", "dilation", "closing", "opening"],
    "noise": ["gaussian_1", "gaussian_2", "gaussian_3", "gaussian_4", "median_1", "median_2"],
    "spatial": ["foreground_percent", "gradients_1", "gradients_2", "gradients_3"],
    "statistical": ["entropy_1", "entropy_2", "entropy_3", "entropy_4", "entropy_5", "entropy_6",
                    "entropy_7", "mean_sd_1", "mean_sd_2", "grounds_mean_1", "grounds_mean_2"],
}
# --- end of fixed values ---

FEATURES = [f"{cat}_{name}" for cat, names in FEATURES_BY_CATEGORY.items() for name in names]
DOTTED_NAMES = {f"{cat}_{name}": f"{cat}.{name}"
                for cat, names in FEATURES_BY_CATEGORY.items() for name in names}
LABELS = ["tess_acc", "fine_acc"]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_long, _int, _dbl, _str = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

PAGE_ROWS = _struct(("image_id", _long), ("y", _int), ("px", T.ArrayType(_int)))
COMPONENTS = _struct(("image_id", _long), ("label", _long), ("x", _int), ("y", _int),
                     ("w", _int), ("h", _int), ("area", _long))
FEATURE_TABLE = _struct(("device", _str), ("file_name", _str),
                        *[(c, _dbl) for c in FEATURES + LABELS])
METRIC_TABLE = _struct(("run_id", _str), ("name", _str), ("value", _dbl))
LEDGER = _struct(("run_id", _str), ("run_name", _str), ("experiment", _str),
                 ("start_time", T.TimestampType()), ("end_time", T.TimestampType()),
                 ("params", T.MapType(_str, _str)), ("metrics", T.MapType(_str, _dbl)),
                 ("tags", T.MapType(_str, _str)))
SCORES = _struct(("ts", T.TimestampType()), ("image_id", _str), ("score", _dbl),
                 ("is_error", T.BooleanType()))
