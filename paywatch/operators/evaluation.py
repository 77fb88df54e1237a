"""Ranking metrics and operating points on (tx_id, label, score), optionally per group.

Everything starts from the curve: one row per distinct score with the rows at and above it. The
curve comes from one grouped aggregate and `running_totals`, so neither rows nor scores are sorted
in one task. `by` names grouping columns with few values (model, window).
"""

from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.functions.scalars import flag, round_half_even
from paywatch.operators.running_totals import running_totals

COUNTS = ["pos", "neg"]


def score_histogram(scores: DataFrame, by=()) -> DataFrame:
    return scores.groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def score_curve(scores: DataFrame, by=()) -> DataFrame:
    """(by, score, pos, neg, cum_pos, cum_neg, total_pos, total_neg), cumulative from the highest score."""
    return running_totals(score_histogram(scores, by), "score", COUNTS, by, descending=True)


def _average_precision():
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return F.try_divide(F.sum(F.col("pos") * precision), F.max("total_pos"))


def _roc_auc():
    """Ties count half; null with one class."""
    wins = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    return F.try_divide(wins, F.max("total_pos").cast("double") * F.max("total_neg"))


def _ks():
    pos = F.col("cum_pos") / F.greatest(F.col("total_pos"), F.lit(1))
    neg = F.col("cum_neg") / F.greatest(F.col("total_neg"), F.lit(1))
    return F.max(F.abs(pos - neg))


def ranking_metrics(scores: DataFrame, by=()) -> DataFrame:
    """(by, n, positives, auc_pr, roc_auc, ks) from one curve."""
    return score_curve(scores, by).groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("positives"),
        _average_precision().alias("auc_pr"), _roc_auc().alias("roc_auc"), _ks().alias("ks"),
    )


def average_precision(scores: DataFrame, by=()) -> DataFrame:
    return ranking_metrics(scores, by).select(*by, "auc_pr")


def roc_auc(scores: DataFrame, by=()) -> DataFrame:
    return ranking_metrics(scores, by).select(*by, "roc_auc")


def ks_stat(scores: DataFrame, by=()) -> DataFrame:
    return ranking_metrics(scores, by).select(*by, "ks")


# ---- thresholds -------------------------------------------------------------------------------

def confusion_matrix(scores: DataFrame, threshold=0.5, by=()) -> DataFrame:
    """(by, tn, fp, fn, tp) when scores at or above the threshold raise an alert."""
    alert, fraud = F.col("score") >= threshold, F.col("label") == 1
    return scores.groupBy(*by).agg(
        F.count_if(~alert & ~fraud).alias("tn"), F.count_if(alert & ~fraud).alias("fp"),
        F.count_if(~alert & fraud).alias("fn"), F.count_if(alert & fraud).alias("tp"),
    )


def classification_report(scores: DataFrame, threshold=0.5, names=("legit", "fraud")) -> DataFrame:
    """(name, precision, recall, f1, support): both classes, accuracy, macro and weighted averages."""
    m = confusion_matrix(scores, threshold)
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    classes = []
    for hit, wrong, missed in ((tn, fn, fp), (tp, fp, fn)):
        precision, recall = share(hit, hit + wrong), share(hit, hit + missed)
        classes.append((precision, recall, share(2 * precision * recall, precision + recall), hit + missed))
    a, b = classes
    macro = [(a[i] + b[i]) / 2 for i in range(3)]
    weighted = [share(a[i] * a[3] + b[i] * b[3], n) for i in range(3)]
    accuracy = share(tn + tp, n)
    rows = [
        (names[0], *a), (names[1], *b), ("accuracy", accuracy, accuracy, accuracy, n),
        ("macro avg", *macro, n), ("weighted avg", *weighted, n),
    ]
    return m.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                 s.cast("bigint").alias("support"))
        for name, p, r, f, s in rows
    ])))


def threshold_grid(scores: DataFrame) -> DataFrame:
    """(threshold, tn, fp, fn, tp, youden, f2) for 0.01 .. 0.99.

    Scores fall into at most 100 steps of the grid first, so the sums run over 100 rows.
    """
    grid = [i / 100.0 for i in range(1, 100)]
    # Steps at or below the score: an estimate by rounding down, corrected against the grid value itself.
    guess = F.greatest(F.least(F.floor(F.col("score") * 100), F.lit(99)), F.lit(0))
    step = (
        F.when((guess < 99) & (F.col("score") >= (guess + 1) / 100.0), guess + 1)
        .when((guess > 0) & (F.col("score") < guess / 100.0), guess - 1)
        .otherwise(guess)
    )
    steps = scores.select("label", step.cast("int").alias("step")).groupBy("step").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    # One array of at most 100 steps; each grid point adds up the steps at or above it.
    row = steps.agg(F.collect_list(F.struct("step", "pos", "neg")).alias("s"),
                    F.sum("pos").alias("p"), F.sum("neg").alias("q"))

    def above(field):
        return F.aggregate(
            F.filter("s", lambda x: x["step"] >= F.col("i")), F.lit(0).cast("bigint"), lambda total, x: total + x[field]
        )

    points = row.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(len(grid))))).select(
        (F.col("i") / 100.0).cast("double").alias("threshold"),
        (F.col("q") - above("neg")).alias("tn"), above("neg").alias("fp"),
        (F.col("p") - above("pos")).alias("fn"), above("pos").alias("tp"),
    )
    recall = F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    specificity = F.col("tn") / F.greatest(F.col("tn") + F.col("fp"), F.lit(1))
    precision = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    # F-beta with beta 2: recall weighs more.
    f2 = F.when(precision + recall > 0, 5 * precision * recall / (4 * precision + recall)).otherwise(0.0)
    return points.withColumns({"youden": recall + specificity - 1, "f2": f2})


def best_threshold(scores: DataFrame, metric="youden") -> DataFrame:
    """(threshold, value): the lowest grid point with the highest value."""
    return threshold_grid(scores).orderBy(F.desc(metric), "threshold").limit(1).select(
        "threshold", F.col(metric).alias("value")
    )


# ---- budgets ----------------------------------------------------------------------------------

def _budgets(curve: DataFrame, asks) -> DataFrame:
    """One row per ask: the score of the k-th row from the top, and what lies at or above it.

    `asks` are (name, column of k) pairs; k is held between 1 and the number of rows.
    """
    n = F.col("total_pos") + F.col("total_neg")
    rows, pos = F.col("cum_pos") + F.col("cum_neg"), F.col("cum_pos")
    fields = []
    for name, k in asks:
        k = F.least(F.greatest(k, F.lit(1)), n)
        reached = rows >= k
        fields.append(F.struct(
            F.lit(name).alias("ask"), F.max(k).cast("bigint").alias("k"), F.max(n).alias("n"),
            F.max("total_pos").alias("total_pos"),
            F.max(F.when(reached, F.col("score"))).alias("threshold"),
            F.min(F.when(reached, rows)).alias("alerts"), F.min(F.when(reached, pos)).alias("tp"),
            F.coalesce(F.max(F.when(~reached, rows)), F.lit(0)).alias("rows_above"),
            F.coalesce(F.max(F.when(~reached, pos)), F.lit(0)).alias("tp_above"),
        ))
    return curve.agg(F.array(*fields).alias("a")).select(F.inline("a"))


def alert_budget(scores: DataFrame, rates=settings.ALERT_RATES) -> DataFrame:
    """(rate, k, threshold, alerts, tp, fp, precision, recall). Ties at the threshold all raise alerts."""
    n = F.col("total_pos") + F.col("total_neg")
    found = _budgets(score_curve(scores), [(float(r), round_half_even(n * F.lit(float(r)))) for r in rates])
    fp = F.col("alerts") - F.col("tp")
    return found.select(
        F.col("ask").alias("rate"), "k", "threshold", "alerts", "tp", fp.alias("fp"),
        (F.col("tp") / F.greatest(F.col("alerts"), F.lit(1))).alias("precision"),
        (F.col("tp") / F.greatest(F.col("total_pos"), F.lit(1))).alias("recall"),
    )


def _top_k(scores: DataFrame, asks, skip_larger) -> DataFrame:
    """Hits among the first k rows by (score descending, tx_id).

    Rows above the k-th score are counted on the curve; only rows tied at it are ordered by id, again
    by running totals, so a score shared by many rows is no single-task sort.
    """
    found = _budgets(score_curve(scores), asks)
    if skip_larger:
        found = found.filter(F.col("ask") <= F.col("n"))
    cuts = found.select("ask", F.col("threshold").alias("score"), (F.col("k") - F.col("rows_above")).alias("rest"))
    tied = scores.join(F.broadcast(cuts), "score").select(  # one row per asked k
        "ask", "rest", "tx_id", F.lit(1).alias("one"), flag(F.col("label") == 1).alias("hit")
    )
    ordered = running_totals(tied, "tx_id", ["one", "hit"], by=["ask"])
    extra = ordered.groupBy("ask").agg(F.max(F.when(F.col("cum_one") <= F.col("rest"), F.col("cum_hit"))).alias("extra"))
    out = found.join(extra, "ask", "left")
    tp = F.col("tp_above") + F.coalesce("extra", F.lit(0))
    return out.select("ask", "k", tp.alias("tp"), "n", "total_pos").withColumns({
        "precision": F.col("tp") / F.col("k"),
        "recall": F.col("tp") / F.greatest(F.col("total_pos"), F.lit(1)),
    })


def top_k_counts(scores: DataFrame, counts=settings.TOP_K_COUNTS) -> DataFrame:
    """(k, precision, recall, tp); counts above the number of rows are skipped."""
    found = _top_k(scores, [(int(k), F.lit(int(k))) for k in counts], skip_larger=True)
    return found.select("k", "precision", "recall", "tp")


def top_k_shares(scores: DataFrame, shares=settings.TOP_K_SHARES) -> DataFrame:
    """(share, k, precision, recall, tp)."""
    n = F.col("total_pos") + F.col("total_neg")
    found = _top_k(scores, [(float(s), round_half_even(n * F.lit(float(s)))) for s in shares], skip_larger=False)
    return found.select(F.col("ask").alias("share"), "k", "precision", "recall", "tp")


def top_k_clamped(scores: DataFrame, k: int) -> DataFrame:
    """(k, precision, recall, tp) with k held between 1 and the number of rows."""
    return _top_k(scores, [(int(k), F.lit(int(k)))], skip_larger=False).select("k", "precision", "recall", "tp")


def top_k_rows(scores: DataFrame, k: int) -> DataFrame:
    """The k highest rows themselves, ties by id."""
    return scores.orderBy(F.desc("score"), "tx_id").limit(k)


def investigation_capacity(scores: DataFrame, counts=settings.CAPACITY_COUNTS) -> DataFrame:
    """(k, tp, pct_caught, precision) when only the first k payments can be reviewed."""
    found = top_k_counts(scores, counts)
    return found.select("k", "tp", (F.col("recall") * 100).alias("pct_caught"), "precision")


# ---- over time --------------------------------------------------------------------------------

def backtest_metrics(scores: DataFrame) -> DataFrame:
    """(window_days, n, auc_pr, ks) per trailing window; windows with one class are left out."""
    found = ranking_metrics(scores, ["window_days"])
    both = (F.col("positives") > 0) & (F.col("positives") < F.col("n"))
    return found.filter(both).select("window_days", "n", "auc_pr", "ks")


def stability_trend(backtest: DataFrame) -> DataFrame:
    """(short_days, long_days, ks_short, ks_long, trend); no row for fewer than two windows."""
    row = backtest.agg(
        F.count("*").alias("windows"),
        F.min("window_days").alias("short_days"), F.max("window_days").alias("long_days"),
        F.min_by("ks", "window_days").alias("ks_short"), F.max_by("ks", "window_days").alias("ks_long"),
    )
    trend = F.when(F.col("ks_long") < F.col("ks_short"), "drops").otherwise("stable/improves")
    return row.filter("windows >= 2").drop("windows").withColumn("trend", trend)


def run_summary(train: DataFrame, scores: DataFrame, cutoff) -> DataFrame:
    """One row: sizes, test rate, ranking metrics and the Youden threshold of a scored test set."""
    return ranking_metrics(scores).select(
        F.col("n").alias("n_test"), F.try_divide("positives", "n").alias("test_fraud_rate"), "auc_pr", "roc_auc", "ks"
    ).withColumns({
        "cutoff_ts": cutoff,
        "n_train": train.agg(F.count("*")).scalar(),
        "best_threshold_youden": best_threshold(scores).select("threshold").scalar(),
    })
