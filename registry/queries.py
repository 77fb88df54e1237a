"""Registered queries: each takes (spark, folder of parquet tables) and returns a DataFrame.

Numbers are rounded and times are text here, only so that results compare exactly with the SQL in
`registry.oracle`. Fixture data covers 30 days, hence the shorter split and window settings.
"""

from pyspark.sql import functions as F

from paywatch.columns import (
    FROM_KEYS, KEYS, LEAKY_FEATURES, MODEL_FEATURES, STRICT_FEATURES, TO_KEYS, TS, select_present,
)
from paywatch.functions import scalars
from paywatch.operators import (
    account_windows, asof_counts, boosting, dedup, enrichment, evaluation, hot_keys, models, preparation, profile_state, quality,
    quantiles, sampling, splits, tuning,
)
from paywatch.operators.cleaning import clean_transactions, rejected_transactions
from paywatch.plans.features import (
    build_transaction_features, payment_features, transaction_features as transaction_table,
)
from paywatch.session import new_path, stage
from paywatch.sources import event_payments as source, runs, tables

DAYS = 10
BACKTEST_DAYS = (3, 7, 14)
PREPARED = ["amount_paid", "time_since_last_txn_from", "txn_amount_std_7d_from", "pct_change_vs_prev"]


NULLABLE_COUNTS = {"time_since_last_txn_from", "time_since_last_txn_to", "to_entity_id", "from_entity_id",
                   "from_num_accounts_per_entity", "to_num_accounts_per_entity"}


def rounded(df, digits=4):
    """Doubles to `digits` decimals (half up), times to text, whole numbers that may be null to doubles."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if kind == "double":
            c = F.floor(c * 10**digits + 0.5) / float(10**digits)
        elif f.name in NULLABLE_COUNTS:
            c = c.cast("double")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---- inputs -----------------------------------------------------------------------------------

def raw(spark, d):
    return source.raw_transactions(spark, d)


def accounts(spark, d):
    return source.raw_accounts(spark, d)


def payments(spark, d):
    return clean_transactions(raw(spark, d))


def outgoing(spark, d):
    return account_windows.outgoing_features(payments(spark, d), hot_keys.find_hot_keys(raw(spark, d), FROM_KEYS))


def incoming(spark, d):
    return account_windows.incoming_features(payments(spark, d), hot_keys.find_hot_keys(raw(spark, d), TO_KEYS))


def features(spark, d):
    """Keys, label and model inputs of every payment. Payments are parsed once: counts, hot rows and windows read what was written."""
    return _features(stage(payments(spark, d), "payments"))


def _features(tx):
    return payment_features(tx, *hot_keys.find_hot_sides(tx, FROM_KEYS, TO_KEYS))


def dated(spark, d):
    """Payments under the feature table's names, without the window columns."""
    return payments(spark, d).withColumnRenamed("ts", TS)


def scores(spark, d):
    """Written once, as predictions are; metrics then read the written table."""
    return stage(source.synthetic_scores(payments(spark, d)), "scores")


def model_scores(spark, d):
    tx = payments(spark, d)
    paid = source.synthetic_scores(tx).withColumn("model", F.lit("paid"))
    received = source.synthetic_scores(tx, "amount_received").withColumn("model", F.lit("received"))
    return stage(paid.unionByName(received), "scores")


def window_scores(spark, d):
    return splits.trailing_windows(stage(source.synthetic_scores(payments(spark, d), keep=["ts"]), "scores"),
                                   BACKTEST_DAYS, "ts")


# ---- scans, tables ----------------------------------------------------------------------------

def scan_transactions(spark, d):
    """Amounts as numbers: engines print doubles differently."""
    numbers = {c: scalars.to_double(c) for c in ("amount_paid", "amount_received", "to_account")}
    return rounded(raw(spark, d).withColumns(numbers))


def scan_accounts(spark, d):
    return accounts(spark, d)


def _table(spark, name):
    path = new_path(spark, name)
    table = f"paywatch_{name}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return table, path


def sink_overwrite_roundtrip(spark, d):
    table, path = _table(spark, "overwrite")
    out = dated(spark, d).select("tx_id", TS, "amount_paid")
    tables.overwrite_features(out, table, path, files_per_day=1)
    return rounded(spark.table(table).select("tx_id", TS, "amount_paid"))


def sink_append_roundtrip(spark, d):
    table, path = _table(spark, "append")
    out = dated(spark, d).select("tx_id", "payment_format", "amount_paid")
    tables.append_table(out.filter("amount_paid < 50000"), table, path)
    tables.append_table(out.filter("amount_paid >= 50000").drop("payment_format"), table)
    return rounded(spark.table(table))


def append_twice_roundtrip(spark, d):
    """Two runs' rows, the first run's written again by a retry: one copy of each."""
    table, path = _table(spark, "append_once")
    out = dated(spark, d).select("tx_id", "payment_format", "amount_paid",
                                 F.when(F.col("amount_paid") < 50000, "first").otherwise("second").alias("run_id"))
    for run in ("first", "second", "first"):
        tables.append_once(out.filter(F.col("run_id") == run), table, path=path)
    return rounded(spark.table(table))


def overwrite_while_reading(spark, d):
    """A table replaced by rows made from itself while a reader of the old version goes on."""
    view = "paywatch_versions"
    spark.sql(f"DROP VIEW IF EXISTS {view}")
    out, path = dated(spark, d).select("tx_id", TS, "amount_paid"), new_path(spark, "versions")
    tables.replace_version(tables.by_day(out.filter("amount_paid < 50000")), view, path, ["event_date"])
    reader = spark.table(view)
    tables.replace_version(spark.table(view).filter("amount_paid >= 1000").unionByName(
        out.filter("amount_paid >= 50000").withColumn("event_date", F.to_date(TS))), view, path, ["event_date"])
    new = spark.table(view).select("tx_id", "amount_paid", F.lit("new").alias("version"))
    return rounded(new.unionByName(reader.select("tx_id", "amount_paid", F.lit("old").alias("version"))))


def add_missing_column(spark, d):
    table, path = _table(spark, "evolve")
    tables.append_table(dated(spark, d).select("tx_id", "amount_paid"), table, path)
    first = tables.add_column_if_absent(spark, table, "run_id", "string")
    second = tables.add_column_if_absent(spark, table, "run_id", "string")
    return rounded(spark.table(table).withColumn("added", F.lit(f"{first},{second}")))


def align_to_target(spark, d):
    target = dated(spark, d).select("tx_id", F.lit("").alias("note"), "is_laundering", "amount_paid").schema
    return rounded(tables.align_to(dated(spark, d).select("amount_paid", "tx_id", "payment_format", "is_laundering"), target))


def select_model_columns(spark, d):
    wanted = ["tx_id", "is_laundering", "amount_paid", "hour_of_day", "same_bank", "no_such_column"]
    return rounded(select_present(scalars.with_calendar(payments(spark, d)), wanted))


def exclude_leaky_features(spark, d):
    return rounded(features(spark, d).drop(*LEAKY_FEATURES).select("tx_id", *STRICT_FEATURES))


# ---- cleaning, calendar, amounts, accounts ----------------------------------------------------

def clean(spark, d):
    return rounded(payments(spark, d))


def rejected(spark, d):
    return rejected_transactions(raw(spark, d)).select("tx_id", "reason")


def label_normalize(spark, d):
    return raw(spark, d).select("tx_id", scalars.to_label("is_laundering").alias("is_laundering"))


def calendar_features(spark, d):
    out = scalars.with_calendar(payments(spark, d))
    return out.select("tx_id", F.date_format("tx_date", "yyyy-MM-dd").alias("tx_date"),
                      "hour_of_day", "day_of_week", "is_weekend", "same_bank")


def amount_flags(spark, d):
    out = scalars.with_amount_flags(payments(spark, d))
    return rounded(out.select("tx_id", "log_amount", "is_large_txn", "is_rounded_amount", "currencies_different"))


def entity_account_counts(spark, d):
    return enrichment.entity_account_counts(source.with_duplicate_accounts(accounts(spark, d)))


def enrich_accounts(spark, d):
    hot = hot_keys.find_hot_sides(raw(spark, d), FROM_KEYS, TO_KEYS)
    out = enrichment.enrich(payments(spark, d), source.with_duplicate_accounts(accounts(spark, d)), *hot)
    return rounded(out.select(
        "tx_id", *[f"{s}_{c}" for s in ("from", "to") for c in ("entity_id", "entity_name", "bank_name")]))


def enrich_entity_counts(spark, d):
    hot = hot_keys.find_hot_sides(raw(spark, d), FROM_KEYS, TO_KEYS)
    out = enrichment.enrich(payments(spark, d), accounts(spark, d), *hot)
    return rounded(out.select("tx_id", "from_num_accounts_per_entity", "to_num_accounts_per_entity"))


# ---- windows ----------------------------------------------------------------------------------

def _columns(frame, *columns):
    def query(spark, d):
        return rounded(frame(spark, d).select("tx_id", *columns))
    return query


def ratio_features(spark, d):
    return rounded(scalars.with_ratios(outgoing(spark, d)).select(
        "tx_id", "amount_vs_7d_avg_ratio", "amount_zscore_7d_from", "pct_change_vs_prev", "txn_velocity_7d_from"))


def transaction_features(spark, d):
    return rounded(build_transaction_features(raw(spark, d), accounts(spark, d)))


def transaction_features_spread(spark, d):
    """The same table with every account treated as a hot one."""
    everything = [hot_keys.HotKeys(tuple(k), everything=True) for k in (FROM_KEYS, TO_KEYS)]
    return rounded(payment_features(payments(spark, d), *everything))


def transaction_features_hot(spark, d):
    """The whole table with low thresholds: some accounts are hot, and some of their minutes are cut."""
    tx = stage(payments(spark, d), "payments")
    hot = hot_keys.find_hot_sides(tx, FROM_KEYS, TO_KEYS, min_rows=40)
    hot = [h.with_busy_minutes(tx, max_rows=1) for h in hot]
    return rounded(transaction_table(tx, accounts(spark, d), *hot))


def busiest_accounts(spark, d):
    return hot_keys.busiest_accounts(payments(spark, d), FROM_KEYS, 50)


# ---- quality ----------------------------------------------------------------------------------

def label_summary(spark, d):
    return rounded(quality.label_summary(payments(spark, d)), 6)


def time_span(spark, d):
    return rounded(quality.time_span(dated(spark, d)))


def null_rates(spark, d):
    return rounded(quality.null_rates(features(spark, d)).withColumnRenamed("column", "column_name"), 6)


def bad_values(spark, d):
    r = raw(spark, d).select(
        scalars.to_double("amount_paid").alias("amount_paid"), scalars.to_double("amount_received").alias("amount_received"),
        F.col("is_laundering").try_cast("int").alias("is_laundering"))
    return quality.bad_values(r)


def duplicate_keys(spark, d):
    tx = source.with_duplicate_payments(dated(spark, d))
    return quality.duplicate_keys(tx)


def numeric_stats(spark, d):
    return rounded(quality.numeric_stats(features(spark, d)).withColumnsRenamed(
        {"column": "column_name", "avg": "mean_value", "std": "std_value", "min": "min_value", "max": "max_value"}), 3)


RANGES = {"all": (0, 1000), "first": (0, 10), "week": (12, 19)}  # days after the first one


def profile_merged(spark, d):
    """Statistics of ranges of days from merged daily states; no range reads the payments again."""
    state = stage(profile_state.column_state(features(spark, d), MODEL_FEATURES), "column_state")
    first = state.agg(F.min("day")).scalar()
    parts = []
    for name, (low, high) in RANGES.items():
        days = state.where((F.datediff("day", first) >= low) & (F.datediff("day", first) < high))
        out = profile_state.merged_columns(days).select(
            "column", "rows", "n", F.col("avg").alias("mean_value"), F.col("std").alias("std_value"), F.col("min").alias("min_value"),
            F.col("max").alias("max_value"))
        parts.append(rounded(out.withColumn("days", F.lit(name)).withColumnRenamed("column", "column_name"), 3))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def profile_correlations(spark, d):
    """Correlations of a range of days from merged daily states."""
    rows = features(spark, d).select(TS, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in STRICT_FEATURES])
    state = stage(profile_state.pair_state(rows, STRICT_FEATURES), "pair_state")
    days = state.where(F.datediff("day", state.agg(F.min("day")).scalar()).between(5, 20))
    found = profile_state.merged_correlations(days, STRICT_FEATURES)
    return found.withColumn("abs_r", F.round("abs_r", 4))


def percentiles_exact(spark, d):
    out = quality.percentiles(stage(features(spark, d), "features"), MODEL_FEATURES, exact=True)
    return rounded(out.select(F.col("column").alias("column_name"), "share", "value"))


def percentiles_approx(spark, d):
    """Whether each approximate percentile is a value whose rank is off by at most rows / accuracy."""
    data = stage(features(spark, d), "features")
    found = quality.percentiles(data)
    value = F.col("v").cast("double")
    values = data.unpivot([], [F.col(c).cast("double").alias(c) for c in MODEL_FEATURES], "column", "v").filter("v is not null")
    ranks = values.join(F.broadcast(found), "column").groupBy("column", "share").agg(
        F.count("*").alias("n"), F.count_if(value < F.col("value")).alias("below"), F.count_if(value <= F.col("value")).alias("upto"))
    off, rank = F.col("n") / quantiles.ACCURACY + 1, F.col("share") * F.col("n")
    return ranks.select(F.col("column").alias("column_name"), "share", (
        (F.col("below") <= rank + off) & (F.col("upto") >= rank - off) & (F.col("upto") > F.col("below"))).alias("within"))


def column_medians(spark, d):
    out = preparation.medians(stage(features(spark, d), "features"), STRICT_FEATURES)
    return rounded(out.select(F.col("column").alias("column_name"), F.col("value").alias("median_value")))


def validation_report(spark, d):
    return rounded(quality.validation_report(features(spark, d), "transaction_features").drop("generated_at"), 6)


def class_weights(spark, d):
    return rounded(quality.class_weights(payments(spark, d)), 6)


def pre_train_checks(spark, d):
    return quality.sample_checks(splits.with_split(dated(spark, d), DAYS))


def training_sample_profile(spark, d):
    train, _ = splits.train_test(features(spark, d), DAYS)
    sample = sampling.stratified_sample(train, {0: 0.5, 1: 1.0})
    return rounded(quality.sample_profile(sample, STRICT_FEATURES).withColumnsRenamed(
        {"column": "column_name", "min": "min_value", "max": "max_value", "mean": "mean_value"}), 3)


def correlation_pairs(spark, d):
    filled = _imputation(spark, d)[0]
    return rounded(preparation.correlation_pairs(filled, STRICT_FEATURES))


# ---- samples and splits -----------------------------------------------------------------------

def time_split(spark, d):
    return splits.with_split(dated(spark, d), DAYS).select("tx_id", "split")


def class_sample(spark, d):
    return sampling.class_sample(payments(spark, d), {0: 0.08, 1: 0.8}).select("tx_id", "is_laundering")


def sample_exact_n(spark, d):
    return sampling.class_cap(payments(spark, d), {0: 1000}).select("tx_id", "is_laundering")


def class_cap(spark, d):
    return sampling.class_cap(payments(spark, d), {0: 500, 1: 10}).select("tx_id", "is_laundering")


def stratified_sample(spark, d):
    out = sampling.stratified_sample(payments(spark, d), {0: 0.5, 1: 0.9}, {0: 2000, 1: 40})
    return rounded(out.select("tx_id", "is_laundering", "amount_paid"))


def _test(spark, d):
    return splits.train_test(dated(spark, d), DAYS)[1]


def enforce_positive_rate_down(spark, d):
    return sampling.enforce_positive_rate(_test(spark, d), 0.005).select("tx_id", "is_laundering")


def enforce_positive_rate_up(spark, d):
    return sampling.enforce_positive_rate(_test(spark, d), 0.05).select("tx_id", "is_laundering")


def natural_rate_test(spark, d):
    tx = splits.train_test(source.with_duplicate_payments(dated(spark, d)), DAYS)[1]
    return sampling.natural_rate_sample(tx, max_rows=3000).select("tx_id", "is_laundering")


def dedupe_keys(spark, d):
    return rounded(dedup.dedupe_keys(source.with_duplicate_payments(dated(spark, d))).select("tx_id", *KEYS, "amount_paid"))


def backtest_windows(spark, d):
    out = splits.backtest_windows(dated(spark, d), BACKTEST_DAYS, {0: 0.5, 1: 0.9}, {0: 400, 1: 8})
    return out.select("tx_id", "is_laundering", "window_days")


def time_series_folds(spark, d):
    out = splits.time_series_folds(dated(spark, d))
    return out.groupBy("fold", "role").agg(
        F.count("*").alias("n"), F.date_format(F.min(TS), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
        F.date_format(F.max(TS), "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


# ---- preparation ------------------------------------------------------------------------------

def _imputation(spark, d, columns=STRICT_FEATURES):
    """(filled train, filled test, plan): fitted before the cutoff."""
    wanted = ["tx_id", TS, "is_laundering", *columns]
    data = stage(features(spark, d).select(*wanted), "features")
    train, test = splits.train_test(data, DAYS)
    plan = preparation.fit_imputation(train, columns)
    return plan.apply(train), plan.apply(test), plan


def impute_median(spark, d):
    return rounded(_imputation(spark, d, PREPARED)[1].select("tx_id", *PREPARED))


def missing_indicators(spark, d):
    _, test, plan = _imputation(spark, d, PREPARED)
    return test.select("tx_id", *[c for c in plan.columns if c.endswith(preparation.SUFFIX)])


def apply_preprocessing(spark, d):
    keep = ["amount_paid", "pct_change_vs_prev", "txn_amount_std_7d_from_is_missing"]
    _, _, plan = _imputation(spark, d, PREPARED)
    recent = splits.trailing_windows(features(spark, d), (3,))
    return rounded(plan.apply(recent, keep).select("tx_id", *keep))


def correlation_keep_list(spark, d):
    filled, _, plan = _imputation(spark, d)
    keep = preparation.uncorrelated(filled, plan.columns)
    return filled.sparkSession.createDataFrame([(c,) for c in keep], "column_name string")


def standardize(spark, d):
    train, test, _ = _imputation(spark, d, PREPARED)
    return rounded(preparation.fit_standardization(train, PREPARED).apply(test).select("tx_id", *PREPARED))


def neutralize_features(spark, d):
    columns = ["repeat_counterparty_count", "amount_paid"]
    _, test, plan = _imputation(spark, d, columns)
    return rounded(preparation.neutralize(test, plan, columns[:1]).select("tx_id", *columns))


def unique_receivers_asof(spark, d):
    return asof_counts.receivers_asof(payments(spark, d)).select("tx_id", "num_receivers_so_far")


def unique_receivers_asof_spread(spark, d):
    """All accounts by slots, as for hot ones."""
    hot = hot_keys.HotKeys(tuple(FROM_KEYS), everything=True)
    return asof_counts.receivers_asof(payments(spark, d), hot).select("tx_id", "num_receivers_so_far")


def unique_senders_asof(spark, d):
    return asof_counts.senders_asof(payments(spark, d)).select("tx_id", "num_senders_so_far")


# ---- models -----------------------------------------------------------------------------------

SHUFFLED = "8m"  # of the windows' rows in a task, at most, when there are shuffle partitions enough
SMALL = models.TreeParams(n_estimators=5, max_depth=3, subsample=1.0, colsample=1.0)


def _train_test(spark, d, columns):
    """Training and test rows of `columns` of the features, written once, a folder for each: passes over one don't read the other.
    Every payment has a row of features, so the last payment tells the cutoff."""
    tx = stage(payments(spark, d), "payments")
    data = splits.with_split(_features(tx).select(*columns), DAYS, cutoff=splits.holdout_cutoff(tx, DAYS, "ts"))
    data = stage(data, "features", SHUFFLED, folders="split")
    return [data.where(F.col("split") == part).drop("split") for part in ("train", "test")]


def _prepared(spark, d):
    wanted = dict.fromkeys(["tx_id", *KEYS, "is_laundering", *STRICT_FEATURES])  # windows of the leaky columns are dropped
    train, test = _train_test(spark, d, wanted)
    plan = models.fit_preparation(train, STRICT_FEATURES)
    return plan.apply(train), plan.apply(test), plan


def _boosted(spark, d, params=SMALL):
    train, test, plan = _prepared(spark, d)
    return models.fit_boosted_trees(train, plan.keep, params), train, test, plan


def _probabilities(scored):
    """Every row of the test set with whether its score is a probability, and whether scores differ at all."""
    scored = stage(scored.select("tx_id", "is_laundering", "score"), "scored")
    seen = scored.agg(F.min("score") < F.max("score")).scalar()
    return scored.select("tx_id", "is_laundering", F.col("score").between(0, 1).alias("is_probability"), seen.alias("scores_differ"))


def score_gbt(spark, d):
    model, _, test, _ = _boosted(spark, d, models.TreeParams())
    return _probabilities(models.score(model, test))


def score_reloaded(spark, d):
    """Raw test rows scored by a model that was saved with its preparation and loaded again, beside the model at hand."""
    data = stage(features(spark, d), "features")
    train, test = splits.train_test(data, DAYS)
    plan = models.fit_preparation(train, STRICT_FEATURES)
    model = models.fit_logistic(plan.scales.apply(stage(plan.apply(train), "train")), plan.keep, max_iter=20)
    path = models.save_model(models.scorer(plan, model, standardize=True), new_path(spark, "models"), "logistic")
    again = models.score(models.load_model(path), test).select("tx_id", F.col("score").alias("again"))
    both = models.score(model, plan.apply(test, standardize=True)).join(again, "tx_id")
    return both.select("tx_id", "is_laundering", (F.col("score") == F.col("again")).alias("same"), F.col("again").between(0, 1).alias("is_probability"))


def score_forest(spark, d):
    train, test, plan = _prepared(spark, d)
    model = models.fit_forest(train, plan.keep, trees=10, depth=4)
    return _probabilities(models.score(model, test))


def score_logreg(spark, d):
    train, test, plan = _prepared(spark, d)
    model = models.fit_logistic(plan.scales.apply(train), plan.keep)
    return _probabilities(models.score(model, plan.scales.apply(test)))


NEWTON = boosting.NewtonParams(rounds=2, depth=2, subsample=1.0, colsample=1.0, bins=16, exact_edges=True)

LEAFWISE = boosting.NewtonParams(rounds=3, depth=2, leaves=3, top_share=0.2, other_share=0.1, colsample=1.0, bins=16,
                                 min_child_weight=1.0, gamma=0.0, exact_edges=True)


def _newton(spark, d, params=NEWTON):
    """Trees of a few rounds on all training rows, every model input to six decimals and 0 where it is null; and the test rows."""
    train, test = _train_test(spark, d, ["tx_id", TS, "is_laundering", *[F.coalesce(
        F.floor(F.col(c).cast("double") * 10**6 + 0.5) / float(10**6), F.lit(0.0)).alias(c) for c in STRICT_FEATURES]])
    return boosting.fit_newton_trees(train, STRICT_FEATURES, params, early_stopping=False), test


def newton_tree_nodes(spark, d):
    return _nodes(_newton(spark, d)[0].nodes(spark))


def _nodes(nodes):
    return rounded(nodes.withColumns({c: F.col(c).cast("double") for c in ("left", "right")}), 6)


def newton_feature_gain(spark, d):
    return rounded(boosting.feature_gain(_newton(spark, d)[0].nodes(spark)), 6)


def score_boosted_newton(spark, d):
    model, test = _newton(spark, d)
    return rounded(model.score(test).select("tx_id", "score"), 6)


def tune_random_search(spark, d):
    data = stage(features(spark, d), "features")
    train, _ = splits.train_test(data, DAYS)
    ranges = {**models.SEARCH_RANGES, "n_estimators": (5, 12, "int"), "max_depth": (2, 3, "int")}
    found = models.search(train, STRICT_FEATURES, models.random_trials(2, ranges=ranges), folds=2)
    means = [m for _, m in found]
    rows = [(i + 1, 5 <= p.n_estimators <= 12 and 2 <= p.max_depth <= 3 and 0.02 <= p.learning_rate <= 0.2,
             0 < m <= 1, m == max(means[i:])) for i, (p, m) in enumerate(found)]
    return spark.createDataFrame(rows, "place int, in_ranges boolean, is_share boolean, in_order boolean")


def tune_adaptive(spark, d):
    """Trials of a small search: how far each got, and whether scores are shares and the one that got furthest led its rungs."""
    train, _ = splits.train_test(stage(features(spark, d), "features"), DAYS)
    ranges = {"rounds": (6, 9, "int"), "learning_rate": (0.05, 0.5, "log"), "reg_lambda": (1.0, 5.0, "float")}
    _, trials, _ = tuning.adaptive_search(train, STRICT_FEATURES, trials=3, batch=3, folds=2, ranges=ranges,
                                          base=boosting.NewtonParams(depth=2, bins=16))
    return rounded(tuning.as_table(spark, trials), 6)


def score_leafwise(spark, d):
    """Trees grown leaf by leaf on rows with large gradients and a sample of the others."""
    model, test = _newton(spark, d, LEAFWISE)
    return rounded(model.score(test).select("tx_id", "score"), 6)


def leafwise_tree_nodes(spark, d):
    return _nodes(_newton(spark, d, LEAFWISE)[0].nodes(spark))


def feature_importance(spark, d):
    model, _, _, plan = _boosted(spark, d)
    found = models.feature_importance(model, plan.keep, spark, top=len(plan.keep))
    return found.agg(F.round(F.sum("gain"), 9).alias("total"), (F.min("gain") >= 0).alias("none_negative"),
                     (F.count_distinct("feature") == len(plan.keep)).alias("one_row_each"))


def stress_test(spark, d):
    model, _, test, plan = _boosted(spark, d)
    found = models.stress_test(model, test, plan)
    return found.select(F.col("auc_pr_base").between(0, 1).alias("base_is_share"),
                        F.col("auc_pr_stressed").between(0, 1).alias("stressed_is_share"),
                        (F.col("delta") == F.col("auc_pr_stressed") - F.col("auc_pr_base")).alias("delta_is_difference"))


def predictions_output(spark, d):
    model, _, test, _ = _boosted(spark, d)
    table, path = _table(spark, "predictions")
    runs.write_predictions(runs.predictions(models.score(model, test), "run", "model_run"), table, path)
    written = spark.table(table)
    stamped = (F.col("model_version") == "model_run") & (F.col("run_id") == "run") & F.col("scored_at").isNotNull()
    return rounded(written.select(*runs.ID_COLUMNS, F.col("fraud_probability").between(0, 1).alias("is_probability"),
                                  stamped.alias("stamped")))


def _summary(spark, d):
    tx = dated(spark, d)
    train, test = splits.train_test(tx, DAYS)
    return evaluation.run_summary(train, source.synthetic_scores(test), splits.holdout_cutoff(tx, DAYS))


def run_summary(spark, d):
    return rounded(_summary(spark, d), 6)


def run_log_row(spark, d):
    row = runs.run_row(_summary(spark, d), "20240101_000000", "model_20240101_000000",
                       {"n_estimators": 5, "learning_rate": 0.1}, STRICT_FEATURES, "models/model_20240101_000000")
    table, path = _table(spark, "runs")
    runs.log_run(spark, row, table, path)
    written = spark.table(table)
    return rounded(written.withColumn("has_time", F.col("created_at").isNotNull().cast("int")).drop("created_at"), 6)


def run_log_json(spark, d):
    return _summary(spark, d).select(
        "n_test", runs.features_json(STRICT_FEATURES[:3]).alias("features_json"),
        runs.params_json({"max_depth": 5, "learning_rate": 0.1}).alias("params_json"))


# ---- evaluation -------------------------------------------------------------------------------

def _scored(function, *args, digits=6):
    def query(spark, d):
        return rounded(function(scores(spark, d), *args), digits)
    return query


def model_benchmark(spark, d):
    return rounded(evaluation.ranking_metrics(model_scores(spark, d), ["model"]).select(
        "model", "auc_pr", "roc_auc", "ks"), 6)


def topk_precision_recall(spark, d):
    """Precision, recall and hits at 200; asks outside [1, n] are held within it."""
    found = scores(spark, d)
    asks = [evaluation.top_k_clamped(found, k).withColumn("ask", F.lit(k).cast("bigint")) for k in (0, 200, 10**9)]
    return rounded(asks[0].unionByName(asks[1]).unionByName(asks[2]), 6)


def topk_rows(spark, d):
    return rounded(evaluation.top_k_rows(scores(spark, d), 200))


def backtest_metrics(spark, d):
    return rounded(evaluation.backtest_metrics(window_scores(spark, d)), 6)


def stability_trend(spark, d):
    return rounded(evaluation.stability_trend(evaluation.backtest_metrics(window_scores(spark, d))), 6)


QUERIES = {
    "scan_transactions": scan_transactions,
    "scan_accounts": scan_accounts,
    "sink_overwrite_roundtrip": sink_overwrite_roundtrip,
    "sink_append_roundtrip": sink_append_roundtrip,
    "append_twice_roundtrip": append_twice_roundtrip,
    "overwrite_while_reading": overwrite_while_reading,
    "add_missing_column": add_missing_column,
    "align_to_target": align_to_target,
    "select_model_columns": select_model_columns,
    "exclude_leaky_features": exclude_leaky_features,
    "clean_transactions": clean,
    "rejected_transactions": rejected,
    "label_normalize": label_normalize,
    "calendar_features": calendar_features,
    "amount_flags": amount_flags,
    "entity_account_counts": entity_account_counts,
    "enrich_accounts": enrich_accounts,
    "enrich_entity_counts": enrich_entity_counts,
    "from_txn_gap": _columns(outgoing, "time_since_last_txn_from"),
    "rolling_counts": _columns(outgoing, "txn_count_1h_from", "txn_count_24h_from", "txn_count_7d_from"),
    "rolling_amounts": _columns(outgoing, "txn_amount_sum_24h_from", "avg_txn_amount_7d_from",
                                "max_txn_amount_7d_from", "txn_amount_std_7d_from"),
    "rolling_gap_std": _columns(outgoing, "txn_gap_std_7d"),
    "cross_bank_ratio": _columns(outgoing, "cross_bank_ratio_7d"),
    "unique_receivers": _columns(outgoing, "num_unique_receivers"),
    "unique_banks": _columns(outgoing, "num_unique_banks"),
    "first_txn_of_day": _columns(outgoing, "first_txn_of_day_from"),
    "counterparty_novelty": _columns(outgoing, "is_new_counterparty", "repeat_counterparty_count"),
    "similar_amounts": _columns(outgoing, "prev_amount_paid", "num_similar_amount_txns_24h"),
    "to_txn_gap": _columns(incoming, "time_since_last_txn_to"),
    "unique_receivers_asof": unique_receivers_asof,
    "unique_receivers_asof_spread": unique_receivers_asof_spread,
    "unique_senders_asof": unique_senders_asof,
    "unique_senders": _columns(incoming, "num_unique_senders"),
    "ratio_features": ratio_features,
    "transaction_features": transaction_features,
    "transaction_features_spread": transaction_features_spread,
    "transaction_features_hot": transaction_features_hot,
    "busiest_accounts": busiest_accounts,
    "label_summary": label_summary,
    "time_span": time_span,
    "null_rates": null_rates,
    "bad_values": bad_values,
    "duplicate_keys": duplicate_keys,
    "numeric_stats": numeric_stats,
    "profile_merged": profile_merged,
    "profile_correlations": profile_correlations,
    "percentiles_exact": percentiles_exact,
    "percentiles_approx": percentiles_approx,
    "column_medians": column_medians,
    "validation_report": validation_report,
    "class_weights": class_weights,
    "pre_train_checks": pre_train_checks,
    "training_sample_profile": training_sample_profile,
    "correlation_pairs": correlation_pairs,
    "time_split": time_split,
    "class_sample": class_sample,
    "sample_exact_n": sample_exact_n,
    "class_cap": class_cap,
    "stratified_sample": stratified_sample,
    "enforce_positive_rate_down": enforce_positive_rate_down,
    "enforce_positive_rate_up": enforce_positive_rate_up,
    "natural_rate_test": natural_rate_test,
    "dedupe_keys": dedupe_keys,
    "backtest_windows": backtest_windows,
    "time_series_folds": time_series_folds,
    "impute_median": impute_median,
    "missing_indicators": missing_indicators,
    "apply_preprocessing": apply_preprocessing,
    "correlation_keep_list": correlation_keep_list,
    "standardize": standardize,
    "neutralize_features": neutralize_features,
    "score_gbt": score_gbt,
    "newton_tree_nodes": newton_tree_nodes,
    "newton_feature_gain": newton_feature_gain,
    "score_boosted_newton": score_boosted_newton,
    "score_reloaded": score_reloaded,
    "score_forest": score_forest,
    "score_logreg": score_logreg,
    "tune_random_search": tune_random_search,
    "tune_adaptive": tune_adaptive,
    "leafwise_tree_nodes": leafwise_tree_nodes,
    "score_leafwise": score_leafwise,
    "feature_importance": feature_importance,
    "stress_test": stress_test,
    "predictions_output": predictions_output,
    "run_summary": run_summary,
    "run_log_row": run_log_row,
    "run_log_json": run_log_json,
    "average_precision": _scored(evaluation.average_precision),
    "roc_auc": _scored(evaluation.roc_auc),
    "ks_stat": _scored(evaluation.ks_stat),
    "model_benchmark": model_benchmark,
    "confusion_matrix": _scored(evaluation.confusion_matrix, 0.75),
    "classification_report": _scored(evaluation.classification_report, 0.75),
    "threshold_grid": _scored(evaluation.threshold_grid),
    "best_threshold_youden": _scored(evaluation.best_threshold, "youden"),
    "best_threshold_f2": _scored(evaluation.best_threshold, "f2"),
    "alert_budget": _scored(evaluation.alert_budget),
    "topk_precision_recall": topk_precision_recall,
    "topk_rows": topk_rows,
    "topk_pct": _scored(evaluation.top_k_shares),
    "topk_abs": _scored(evaluation.top_k_counts),
    "investigation_capacity": _scored(evaluation.investigation_capacity),
    "backtest_metrics": backtest_metrics,
    "stability_trend": stability_trend,
}
