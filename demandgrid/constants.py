"""Fixed values.

Labels, bins, periods and grids below must equal the established ones for results to match,
so they are listed plainly here and nowhere else.
"""

# keys and columns of the fact table
SERIES = ["store_id", "product_id"]
CATEGORY = ["first_category_id", "second_category_id", "third_category_id"]
TARGET = "sale_amount"
TIME = "dt"
VALUE_VECTOR = "hours_stock_status"
SALE_VECTOR = "hours_sale"

# discount bands (label texts carry an en dash)
BAND_NONE = "0% (No discount)"
BAND_LOW = "1–10%"
BAND_MID = "11–20%"
BAND_HIGH = "21%+"

# temperature bands: upper bounds in degrees, then the open-ended label
TEMPERATURE_BANDS = [(10, "Cold"), (20, "Mild"), (30, "Warm")]
TEMPERATURE_TOP = "Hot"

# part of day codes by last hour of the part: night, morning, midday, evening, late
PART_OF_DAY = [(5, 1), (11, 2), (15, 3), (19, 4), (23, 5)]

# performance classes relative to the mean of the group means
CLASS_HIGH = "High Intensity"
CLASS_LOW = "Low Intensity"
CLASS_MEDIUM = "Medium Intensity"
CLASS_HIGH_FACTOR = 1.2
CLASS_LOW_FACTOR = 0.8

# labels of the two rows of question 12
LABEL_POSITIVE_HOURS = "Hours_where_sales_more_than_zero"
LABEL_ZERO_HOURS = "Hours_where_sales_equal_to_zero"

# calendar features
DAY_PARTS = [(6, "night"), (11, "morning"), (17, "afternoon"), (22, "evening"), (24, "late")]
HOLIDAYS = ["05-27", "06-19"]

# feature periods and windows, in rows
LAG_PERIODS = [1, 2, 3, 7, 14, 21]
STOCKOUT_LAG_MAX = 7
ROLLING_WINDOWS = [6, 24, 168]
STOCK_RATIO_WINDOW = 7
FOURIER_PERIODS = [24, 168]
FOURIER_ORDER = 3
SEASONAL_PERIODS = [24, 168]
SEASONAL_PERIOD = 24

# metrics and preprocessing
EPSILON = 1e-8
FINITE_LIMIT = 1e10
MISSING_SHARE_WARNING = 0.5

# training
SAMPLE_FRACTION = 0.01
SEED = 42
CV_FOLDS = 5
METADATA_COLUMNS = ["store_id", "product_id", "city_id", "dt", "sale_amount"]

# configured hyper-parameters per model
MODEL_SETTINGS = {
    "linear": {"fit_intercept": True},
    "ridge": {"alpha": 10.0, "fit_intercept": True},
    "lasso": {"alpha": 0.01, "fit_intercept": True},
    "random_forest": {"n_estimators": 300, "max_depth": 20},
    "gradient_boosting": {"n_estimators": 200, "learning_rate": 0.1, "max_depth": 5},
    "boost_cols": {"n_estimators": 200, "learning_rate": 0.1, "max_depth": 5, "subsample": 1.0, "colsample": 1.0},
}

# defaults used where a model has no configured value
MODEL_DEFAULTS = {
    "linear": {},
    "ridge": {"alpha": 1.0},
    "lasso": {"alpha": 1.0, "max_iter": 1000},
    "elasticnet": {"alpha": 1.0, "l1_ratio": 0.5, "max_iter": 1000},
    "decision_tree": {"max_depth": 10, "min_leaf": 10},
    "random_forest": {"n_estimators": 100, "max_depth": 15, "min_leaf": 5, "features": "sqrt"},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "min_leaf": 5, "subsample": 0.8},
    "boost_cols": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample": 0.8},
}

# tuning grids (None = no depth limit)
MODEL_GRIDS = {
    "linear": {"fit_intercept": [True, False]},
    "ridge": {"alpha": [0.1, 1.0, 10.0], "fit_intercept": [True, False]},
    "lasso": {"alpha": [0.01, 0.1, 1.0], "fit_intercept": [True, False]},
    "random_forest": {"n_estimators": [100, 300], "max_depth": [10, 20, None]},
    "gradient_boosting": {"n_estimators": [100, 200], "learning_rate": [0.01, 0.1], "max_depth": [3, 5]},
    "boost_cols": {
        "n_estimators": [100, 200],
        "learning_rate": [0.01, 0.1],
        "max_depth": [3, 5],
        "subsample": [0.8, 1.0],
        "colsample": [0.8, 1.0],
    },
}

# segmentation
SEGMENT_COUNT = 4
SEGMENT_SWEEP = (2, 10)
SEGMENT_VARIANCE = 0.9
SEGMENT_NAMES = ["Struggling Stores", "Stable but Low Performers", "Mid-Tier Performers", "High Performers"]
