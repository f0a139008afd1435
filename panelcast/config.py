"""Defaults shared by every operator.

Column names of the panel (entity, time, target, regressors) are parameters
of the operators; these are only their defaults.
"""

ENTITY = "Store"
TIME = "Date"
TARGET = "Weekly_Sales"
HOLIDAY_FLAG = "Holiday_Flag"
REGRESSORS = ("Temperature", "Fuel_Price", "CPI", "Unemployment")
PANEL_COLUMNS = (ENTITY, TIME, TARGET, HOLIDAY_FLAG) + REGRESSORS

SEED = 42

# Validation start for the panel built from the driver's star-schema tables:
# the last ten weekly periods (2001-06-01 .. 2001-08-03).
VALIDATION_START = "2001-06-01"

# ---------------------------------------------------------------------------
# Fixed values that must equal the forecasting specification
# ---------------------------------------------------------------------------
# Lags (weeks), rolling windows (weeks), EWMA spans; min/max only for windows <= 8.
LAGS = (1, 2, 4, 8, 12, 52)
ROLLING_WINDOWS = (4, 8, 12, 26)
MINMAX_MAX_WINDOW = 8
EWMA_SPANS = (4, 8, 12)
# Holiday windows in days: flag = within +-3 days; pre-Thanksgiving [-14, -3);
# pre-Christmas [-28, -3); Black-Friday week (0, +7].
HOLIDAY_HALF_WIDTH_DAYS = 3
PRE_THANKSGIVING_DAYS = 14
PRE_CHRISTMAS_DAYS = 28
BLACK_FRIDAY_DAYS = 7
NO_HOLIDAY_DEFAULT_DAYS = 52
# Temperature bins, right-closed: (-inf,32] freezing, (32,50] cold, (50,70] mild,
# (70,85] warm, (85,inf) hot.
TEMP_BINS = ((32.0, "freezing"), (50.0, "cold"), (70.0, "mild"), (85.0, "warm"))
TEMP_TOP_LABEL = "hot"
STORE_SIZE_LABELS = ("small", "medium", "large")
CPI_UNEMPLOYMENT_OFFSET = 0.1
TREND_STD_OFFSET = 1.0
# Deviation labels of a scored request: above +10 %, below -10 %.
DEVIATION_THRESHOLD_PCT = 10.0
# Ensemble: keep models whose WMAPE is below 50, need at least two.
ENSEMBLE_MAX_WMAPE = 50.0
ENSEMBLE_MIN_MODELS = 2
HISTOGRAM_BINS = 50
TOP_FEATURES = 20
# Reference holiday calendar (2010-2013) that the rule calendar reproduces.
REFERENCE_HOLIDAYS = {
    "Super_Bowl": ("2010-02-12", "2011-02-11", "2012-02-10", "2013-02-08"),
    "Labour_Day": ("2010-09-10", "2011-09-09", "2012-09-07", "2013-09-06"),
    "Thanksgiving": ("2010-11-26", "2011-11-25", "2012-11-23", "2013-11-29"),
    "Christmas": ("2010-12-31", "2011-12-30", "2012-12-28", "2013-12-27"),
}
HOLIDAY_NAMES = ("Super_Bowl", "Labour_Day", "Thanksgiving", "Christmas")

# Model defaults (tree ensembles), 200 trees / rounds.
RF_DEFAULTS = {"n_estimators": 200, "max_depth": 15, "min_samples_split": 5,
               "min_samples_leaf": 2}
XGB_DEFAULTS = {"n_estimators": 200, "max_depth": 8, "learning_rate": 0.05,
                "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 3}
LGB_DEFAULTS = {"n_estimators": 200, "max_depth": 10, "learning_rate": 0.05,
                "num_leaves": 50, "subsample": 0.8, "colsample_bytree": 0.8}
# Settings the boosted models keep at their usual values: ridge on leaf values of the
# depth-wise one, rows a leaf of the best-first one.
DEPTHWISE_L2 = 1.0
BEST_FIRST_MIN_ROWS = 20
# Search spaces (inclusive bounds); learning rates are sampled log-uniformly.
TUNING_TRIALS = 20
RF_SPACE = {"n_estimators": (100, 300), "max_depth": (5, 20),
            "min_samples_split": (2, 15), "min_samples_leaf": (1, 8)}
XGB_SPACE = {"n_estimators": (100, 300), "max_depth": (3, 12),
             "learning_rate": (0.01, 0.2), "subsample": (0.6, 1.0),
             "colsample_bytree": (0.6, 1.0), "min_child_weight": (1, 10)}
LGB_SPACE = {"n_estimators": (100, 300), "max_depth": (3, 15),
             "learning_rate": (0.01, 0.2), "num_leaves": (20, 100),
             "subsample": (0.6, 1.0), "colsample_bytree": (0.6, 1.0)}
# Scoring model input, in order.
SCORING_FEATURES = ("Store", "Holiday_Flag", "Temperature", "Fuel_Price", "CPI",
                    "Unemployment", "year", "month", "week_of_year", "quarter",
                    "month_sin", "month_cos", "week_sin", "week_cos",
                    "temp_squared", "cpi_unemployment")
# Columns never used as model features.
FEATURE_EXCLUDE = ("Date", "Weekly_Sales", "temp_category", "store_size")
