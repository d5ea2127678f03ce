"""Parameters and formats whose values decide the results.

Fixed values: they are part of the behaviour this library reproduces, so they
are stated here once, as they are.
"""

# --- preparation ---------------------------------------------------------
MIN_USER_RATINGS = 5
MIN_MOVIE_RATINGS = 10
SPLIT_QUANTILE = 0.8
SPLIT_ACCURACY = 1000

# --- evaluation ----------------------------------------------------------
METRIC_K = 10
GOOD_RATING = 3.5

# --- ALS -----------------------------------------------------------------
ALS_RANK = 100
ALS_ITERATIONS = 15
ALS_REG = 0.05
ALS_BLOCKS = 100
ALS_COLD_START = "drop"
ALS_INTERMEDIATE_STORAGE = "MEMORY_AND_DISK"
ALS_FINAL_STORAGE = "MEMORY_AND_DISK_SER"

# Where a model is looked for, in order, by the name of the strategy.
MODEL_LOAD_ORDERS = {
    "local-first": ("local", "hdfs"),
    "hdfs-first": ("hdfs", "local"),
    "hdfs-only": ("hdfs",),
}

# --- recommendation lists ------------------------------------------------
LIST_LENGTH = 30
SHOWN_LENGTH = 10
FOLD_IN_REG = 0.1

# --- exploration ---------------------------------------------------------
HISTOGRAM_BINS = 100
HEAD_FRACTION = 0.2
RELEASE_YEAR_PATTERN = r"\((\d{4})\)"

# --- stream and serving --------------------------------------------------
RATINGS_TOPIC = "new_ratings"
MESSAGE_SEPARATOR = ","
TRIGGER_INTERVAL = "15 seconds"
UNKNOWN_TITLE_PREFIX = "Không rõ tên"
