"""Defaults of the pipeline. Every function takes them as parameters."""

# Input format, rule constants and run settings.
TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm"
LARGE_AMOUNT = 100_000
ROUNDED_STEP = 1_000
SIMILAR_AMOUNT_TOLERANCE = 1e-6
TEST_DAYS = 120
SEED = 42
TRAIN_FRACTIONS = {0: 0.08, 1: 0.80}
TEST_FRACTIONS = {0: 0.30, 1: 1.00}
MAX_TEST_ROWS = 500_000
TARGET_TEST_RATE = 0.01
NATURAL_TEST_MAX_ROWS = 1_000_000
BACKTEST_DAYS = (14, 28, 56)
BACKTEST_FRACTIONS = {0: 0.05, 1: 0.50}
BACKTEST_CAPS = {0: 50_000, 1: 5_000}
CORRELATION_LIMIT = 0.95
SEARCH_TRIALS = 30
EARLY_STOPPING_ROUNDS = 30
CV_FOLDS = 4
TOP_K_SHARES = (0.001, 0.005, 0.01)
TOP_K_COUNTS = (1000, 5000, 10000)
ALERT_RATES = (0.001, 0.002, 0.005, 0.01)
DEFAULT_ALERT_RATE = 0.001
CAPACITY_COUNTS = (100, 500, 1000, 5000)
STRESS_FEATURES = ("is_new_counterparty", "repeat_counterparty_count")
MIN_TEST_POSITIVES = 50
MIN_TEST_ROWS = 1_000

# Skew handling (ours). An account with more rows than HOT_KEY_ROWS is aggregated per minute before
# its windows run; a minute of such an account with more rows than that is split by id range. Lists of
# such accounts and minutes are broadcast only while they have at most MAX_HOT_KEYS rows.
HOT_KEY_ROWS = 20_000
MAX_HOT_KEYS = 200_000
