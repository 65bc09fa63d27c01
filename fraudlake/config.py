"""Names, lists and thresholds shared by the whole package."""

KEY = "TransactionID"
TARGET = "isFraud"
TIME = "TransactionDT"
AMOUNT = "TransactionAmt"

# ---- fixed values: columns that make up the feature matrix ----
NUMERIC_FEATURES = [
    "TransactionAmt", "card1", "card2", "card3", "card5", "addr1", "addr2", "dist1", "dist2", "C1",
    "C2", "C3", "C4", "C5", "C6", "C7", "C8", "C9", "C10", "C11", "C12", "C13", "C14", "D1", "D2",
    "D3", "D4", "D5", "D10", "D11", "D15", "V1", "V2", "V3", "V4", "V5", "V6", "V7", "V8", "V9",
    "V10", "V11", "V12", "V13", "V14", "V15", "V16", "V17", "V18", "V19", "V20", "V44", "V45",
    "V46", "V47", "V48", "V49", "V50", "V51", "V52", "V53", "V54", "V55", "V56", "V57", "V58",
    "V59", "V60", "V61", "V62", "V63", "V64", "V65", "V66", "V67", "V68", "V69", "V70", "V71",
    "V72", "V73", "V74", "V75", "V76", "V77", "V78", "V79", "V80", "V81", "V82", "V83", "V84",
    "V85", "V86", "V87", "V88", "V89", "V90", "V91", "V92", "V93", "V94", "V95", "V96", "V97",
    "V98", "V99", "V100",
]
CATEGORICAL_FEATURES = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain"]
ENGINEERED_FEATURES = [
    "TransactionAmt_log",
    "TransactionAmt_decimal",
    "Transaction_hour",
    "Transaction_day",
    "card1_addr1_count",
]
ALL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES + ENGINEERED_FEATURES
IDENTITY_COLUMNS = [f"id_{i:02d}" for i in range(1, 39)] + ["DeviceType", "DeviceInfo"]
REQUIRED_TRANSACTION_COLUMNS = [KEY, TARGET, TIME, AMOUNT]
REQUIRED_IDENTITY_COLUMNS = [KEY]

# ---- fixed values: report column sets ----
OUTLIER_COLUMNS = [AMOUNT, "C1", "C2", "C4", "D1", "D10", "D15"]
CORRELATION_COLUMNS = [
    AMOUNT, "card1", "card2", "card3", "card5", "addr1", "addr2", "dist1",
    "C1", "C2", "C3", "C4", "C5",
    "D1", "D2", "D3", "D4", "D5", "D10", "D15", TARGET,
]

# ---- fixed values: bin edges (right-closed) and their labels ----
AMOUNT_EDGES = [0, 50, 100, 200, 500, 1000, 5000, float("inf")]
AMOUNT_LABELS = ["$0-50", "$50-100", "$100-200", "$200-500", "$500-1K", "$1K-5K", "$5K+"]
MISSING_EDGES = [0, 10, 25, 50, 75, 100]
MISSING_LABELS = ["0-10%", "10-25%", "25-50%", "50-75%", "75-100%"]

# ---- fixed values: request fields and their defaults ----
REQUEST_DEFAULTS = {
    "TransactionAmt": 100.0, "card1": 0.0, "card2": 0.0, "card3": 0.0, "card4": "visa",
    "card5": 0.0, "card6": "debit", "addr1": 0.0, "addr2": 0.0, "dist1": 0.0, "C1": 0.0, "C2": 0.0,
    "C3": 0.0, "C4": 0.0, "C5": 0.0, "C6": 0.0, "C7": 0.0, "C8": 0.0, "C9": 0.0, "C10": 0.0,
    "C11": 0.0, "C12": 0.0, "C13": 0.0, "C14": 0.0, "D1": 0.0, "D2": 0.0, "D3": 0.0, "D4": 0.0,
    "D5": 0.0, "D10": 0.0, "D11": 0.0, "D15": 0.0, "ProductCD": "W", "P_emaildomain": "gmail.com",
}

# ---- fixed values: split, sampling, drift, cache, models ----
TEST_SHARE = 0.2
SEED = 42
REFERENCE_SAMPLE_ROWS = 5_000
DRIFT_SAMPLE_ROWS = 10_000
PLOT_SAMPLE_ROWS = 5_000
MEAN_SHIFT_LIMIT = 0.2
DRIFT_SHARE_LIMIT = 0.05
STD_FLOOR = 1e-8
RELABEL_SHARE = 0.15
AMOUNT_DRIFT_FACTOR = 1.5
SHIFTED_COLUMNS = 20
SHIFT_STDS = 2.0
NOISE_STDS = 0.1
SCORE_THRESHOLD = 0.5
CACHE_TTL_SECONDS = 3_600
JDBC_BATCH_ROWS = 5_000
UNKNOWN = "unknown"
POSITIVE_WEIGHT = 20.0
GBT_PARAMS = {"maxIter": 300, "maxDepth": 7, "stepSize": 0.05, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5}
LR_PARAMS = {"maxIter": 1000, "standardization": False}
LR_INVERSE_PENALTY = 1.0
RF_PARAMS = {"numTrees": 200, "maxDepth": 10}

# ---- engine limits (not part of any result) ----
BROADCAST_ROWS = 1_000_000      # a lookup table above this many rows is never broadcast
BROADCAST_BYTES = 128 << 20     # nor one above this many bytes, see joins.row_bytes
FILTER_BYTES = 32 << 20         # bits of a key filter, see keyfilter
UNSEEN_SHARE = 10               # rows without a partner pass by a shuffle if more than 1/10 of all
HOT_KEY_SHARE = 1_000           # a key with more than 1/1000 of all rows counts as hot
TRAIN_ROWS = 250_000            # rows in a partition while a classifier is fitted, at most
LEAST_TRAIN_ROWS = 10_000       # smaller partitions cost more than they save
TRAIN_PARTITIONS = 24           # up to so many partitions of fewer than TRAIN_ROWS rows
AGG_CHUNK = 48                  # expressions per wide aggregate
