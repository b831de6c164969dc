"""Column names, thresholds and model parameters. Every operator takes these as arguments."""

ZONE = "zone"
DATE = "for_date"
TARGET = "requirement"
STEP_MINUTES = 30

# These must equal the published ones for results to agree.
PLACEHOLDER_LIMIT = 1.0  # |actual| below this is a slot that has not been realised
APE_FLOOR = 1e-6  # smallest denominator of a percentage error
WEEK_LAG = "REQ_LAST168H"
LAG_3D = "REQUIREMENT_LAG_3D"
PEAK = "PEAK_OFFPEAK_NUMERIC"
LAG_COLUMNS = {
    "REQUIREMENT_LAG_1D": 24,
    "REQUIREMENT_LAG_2D": 48,
    "REQUIREMENT_LAG_3D": 72,
    "REQUIREMENT_LAG_4D": 96,
    "REQ_LAST168H": 168,
    "REQ_LAST336H": 336,
    "REQ_LAST504H": 504,
    "REQ_LAST672H": 672,
}
EXCLUDED_FEATURES = ("REQUIREMENT_LAG_1D", "REQUIREMENT_LAG_2D", "REQUIREMENT_LAG_4D")
SERIES_FEATURES = (
    "holiday", "long_holiday", "peakmonth", "is_Saturday", "is_Sunday",
    "REQ_LAST672H", "REQ_LAST504H", "REQ_LAST336H", "REQ_LAST168H",
    "Temp_W", "RealFeel_W", "DewPoint_W", "RelativeHumidity_W", "UVIndex_W",
    "CloudCover_W", "WetBulb_W", "IsDaylight_W", "is_tou",
    "hour", "minute", "DayOfWeek", "day", "month", "year", "TIME_SLOT",
    "REQUIREMENT_LAG_3D", "PEAK_OFFPEAK_NUMERIC",
)
DRIFT_Z_WARN = 1.5
DRIFT_Z_CRITICAL = 2.5
MAPE_ALERT_PCT = 3.0
DRIFT_MAPE_PCT = 5.0
DRIFT_DAYS = 3
MIN_ROWS_BIAS = 24
MIN_ROWS_WEIGHTS = 48
SEQUENCE_LENGTH = 6
SEQUENCE_LENGTH_STANDALONE = 48
CV_FOLDS = 5
DEFAULT_WEIGHTS = {"pred_xgb": 0.50, "pred_lgbm": 0.50, "pred_lstm": 0.00}
PAIR_WEIGHTS = {"pred_xgb": 0.50, "pred_lgbm": 0.50}
MODELS = {
    "XGBoost": "pred_xgb",
    "LightGBM": "pred_lgbm",
    "LSTM": "pred_lstm",
    "Ensemble_XGB_LGBM_LSTM": "pred_ensemble",
    "Ensemble_XGB_LGBM": "pred_ensemble_xgb_lgbm",
}
STANDALONE_MODELS = {
    "XGBoost": "pred_xgb",
    "LightGBM": "pred_lgbm",
    "LSTM": "pred_lstm",
    "Ensemble": "pred_ensemble",
    "Ensemble_W": "pred_ensemble_w",
}
ALERT_TOKEN = "Ensemble_XGB_LGBM"
RUN_STAMP = "yyyyMMdd_HHmmss"
ALERT_DETAIL = "MAPE=%.2f%% BIAS=%.1f"
DRIFT_DETAIL = "z=%.3f"
BIAS_DETAIL = "bias=%.2f corr=%.2f n=%d"
REASON_NO_HISTORY = "no history"
REASON_NO_DATA = "insufficient recent data"
REASON_NO_SCORE = "MAPE nan% OK"
REASON_OK = "MAPE %.2f%% OK"
REASON_DRIFT = "MAPE %.2f%% > threshold {threshold}%% over last {days} days"

# Boosted-tree settings in Spark ML terms: trees, depth, learning rate, row sampling.
TREES_MODULAR = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.9}
TREES_ORG = {"maxIter": 1400, "maxDepth": 8, "stepSize": 0.04, "subsamplingRate": 1.0}
SEED = 42

# Wording of our own, not a stored value.
ALERT_TEXT = "%s: the ensemble is off by %.2f%% on average, above the limit of {limit}%% (bias %.1f MW)"
