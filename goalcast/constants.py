"""Fixed values that must equal the behaviour being reproduced.

Fixed values: label names, feature column lists, null tokens, thresholds and
hyper-parameter grids, stated plainly in their natural order.
"""

# Goal columns recognised as labels (anything else is a feature).
KNOWN_LABELS = ["click", "download", "buy", "register", "video_ad_start"]

# List feature columns (values separated by a literal dot).
DATA_LIST_COLUMNS = ["category"]

# Categorical attribute columns of the raw log, after derivation.
DATA_ATTRIBUTE_COLUMNS = [
    "impression_position_val", "impression_viewability", "app_site_ind", "domain", "publisher",
    "formats", "device_language", "device_make", "device_model",
    "device_os", "device_osv", "loc_country", "country_state", "country_state_city", "zip",
    "datacenter", "browser", "banner", "ad_type", "banner_size", "sub_account_id", "HOW",
]

# Location families renamed to "location" by the location patch, in order.
LOCATION_FAMILIES = ["country_state_city", "country_state", "loc_country", "zip"]
# The family the original loop actually applies (its last iteration).
LOCATION_FAMILIES_OBSERVED = ["zip"]

# Tokens read as null in the raw log: the explicit list first, then the
# default null tokens of the CSV reader the log was read with.
RAW_NULL_TOKENS = [
    "\\N", "nan", "None",
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "null",
]

# Thresholds and rules.
OTHER = "OTHER"
DEFAULT_RARITY_THRESHOLD = 100
MIN_EXAMPLES_PER_CLASS = 10
MIN_DAYS_FOR_TEMPORAL_SPLIT = 14
TRAIN_FRACTION = 0.75
SPLIT_SEED = 0
AUC_DIFF_LIMIT = 0.4
AUC_TEST_MIN = 0.5
AUC_EPS = 1e-11
LOG_LOSS_EPS = 1e-15
DUMMY_FEATURE = "dummy_for_xgb"
RECENT_WEIGHT_INCREMENTAL = 0.5
RECENT_MIN_POSITIVES = 20

# Hyper-parameter grids per model family (name -> options, in file order).
HYPER_PARAMETERS = {
    "SGD": {
        "loss": ["log", "modified_huber", "perceptron", "hinge", "squared_hinge"],
        "penalty": ["l2", "l1", "elasticnet"],
        "alpha": [1e-15, 1e-10, 1e-8, 1e-5, 1e-4, 1e-3, 1e-2, 1, 5, 10],
    },
    "LASSO": {
        "loss": ["log"],
        "penalty": ["l1"],
        "alpha": [1e-15, 1e-10, 1e-8, 1e-5, 1e-4, 1e-3, 1e-2, 1, 5, 10],
    },
    "NB": {
        "alpha": [0.000001, 0.00001, 0.0001, 0.001, 0.01, 0.1, 1],
        "fit_prior": [True, False],
    },
    "POLY2BAYES": {"rarity_threshold": [1, 5, 10, 15, 20]},
    "RF": {
        "ntree": [100, 150],
        "fraction": [1.0, 0.3],
        "min_target_node_size": [10000, 25000, 50000],
    },
    "XGB": {"max_depth": [2, 6], "eta": [0.1, 0.3]},
}

# Family name -> grid file it uses (the family "NB" runs the pair-count grid).
GRID_OF_FAMILY = {
    "nb": "POLY2BAYES", "poly2bayes": "POLY2BAYES", "lasso": "LASSO", "sgd": "SGD",
    "rf": "RF", "xgb": "XGB", "xgbf": "XGB",
}

# Boosted-tree settings.
BOOST_ROUNDS = 100
BOOST_SUBSAMPLE = 0.8
BOOST_COLSAMPLE = 0.8
