import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paywatch.operators import evaluation as ev
from paywatch.operators import quantiles
from paywatch.operators.quantiles import exact_quantiles
from paywatch.operators.running_totals import running_totals
from paywatch.session import stage


def make(spark, n=700, seed=3, tied=0.4, digits=2):
    """Scores with many ties: a `tied` share of all rows has one and the same score."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(draw.random() < 0.15)
        s = 0.37 if draw.random() < tied else round(min(max(draw.gauss(0.3 + 0.3 * y, 0.2), 0), 1), digits)
        rows.append((i, y, float(s)))
    return rows, spark.createDataFrame(rows, "tx_id bigint, label int, score double").repartition(6)


def brute(rows):
    y, s = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    P, N = y.sum(), (1 - y).sum()
    ap, last, ks = 0.0, 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp, fp = y[s >= t].sum(), (1 - y)[s >= t].sum()
        ap += (tp / P - last) * tp / (tp + fp)
        last = tp / P
        ks = max(ks, abs(tp / P - fp / N))
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (P * N)
    return ap, auc, ks


def test_ranking_metrics_against_brute_force(spark):
    rows, df = make(spark)
    got = ev.ranking_metrics(df).first()
    assert np.allclose([got["auc_pr"], got["roc_auc"], got["ks"]], brute(rows), atol=1e-12)


def test_metrics_per_group(spark):
    a, da = make(spark, seed=1)
    b, db = make(spark, n=300, seed=2, digits=3)
    both = da.withColumn("model", F.lit("a")).unionByName(db.withColumn("model", F.lit("b")))
    got = {r["model"]: (r["auc_pr"], r["roc_auc"], r["ks"]) for r in ev.ranking_metrics(both, ["model"]).collect()}
    assert np.allclose(got["a"], brute(a)) and np.allclose(got["b"], brute(b))


def test_one_class(spark):
    df = spark.createDataFrame([(i, 0, i / 10) for i in range(5)], "tx_id bigint, label int, score double")
    got = ev.ranking_metrics(df).first()
    assert got["auc_pr"] is None and got["roc_auc"] is None and got["ks"] == 1.0
    assert ev.alert_budget(df, [0.2]).first()["recall"] == 0.0


@pytest.mark.parametrize("k", [-5, 0, 1, 3, 50, 150, 250, 400, 699, 700, 5000])
def test_top_k_with_ties(spark, k):
    rows, df = make(spark)
    size = min(max(k, 1), len(rows))
    top = sorted(rows, key=lambda r: (-r[2], r[0]))[:size]
    hits, positives = sum(r[1] for r in top), sum(r[1] for r in rows)
    got = ev.top_k_clamped(df, k).first()
    assert (got["k"], got["tp"]) == (size, hits)
    assert np.isclose(got["precision"], hits / size) and np.isclose(got["recall"], hits / positives)


def test_top_k_skips_counts_above_the_rows(spark):
    _, df = make(spark)
    assert sorted(r["k"] for r in ev.top_k_counts(df, (10, 700, 701)).collect()) == [10, 700]


@pytest.mark.parametrize("rate", [0.0001, 0.01, 0.25, 1.0])
def test_alert_budget_flags_all_ties(spark, rate):
    rows, df = make(spark)
    k = max(1, round(len(rows) * rate))
    threshold = sorted((r[2] for r in rows), reverse=True)[k - 1]
    flagged = [r for r in rows if r[2] >= threshold]
    got = ev.alert_budget(df, [rate]).first()
    assert (got["k"], got["threshold"], got["alerts"], got["tp"]) == (k, threshold, len(flagged), sum(r[1] for r in flagged))


def test_half_rounds_to_even(spark):
    df = spark.createDataFrame([(i, i % 2, i / 25) for i in range(25)], "tx_id bigint, label int, score double")
    assert ev.alert_budget(df, [0.1, 0.14]).orderBy("rate").first()["k"] == 2


def test_threshold_search_against_brute_force(spark):
    rows, df = make(spark)
    extra = [(1000 + i, i % 2, s) for i, s in enumerate([0.0, 1.0, 0.57, 0.58, 0.29, 0.07, 0.14, 0.28])]
    rows = rows + extra
    df = df.unionByName(spark.createDataFrame(extra, df.schema))
    y, s = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    best = {"youden": (-1, 0.5), "f2": (-1, 0.5)}
    cells = {}
    for i in range(1, 100):
        t = i / 100.0
        tp, fp = int(y[s >= t].sum()), int((1 - y)[s >= t].sum())
        fn, tn = int(y.sum()) - tp, int((1 - y).sum()) - fp
        cells[t] = (tn, fp, fn, tp)
        rec, spec, prec = tp / max(tp + fn, 1), tn / max(tn + fp, 1), tp / max(tp + fp, 1)
        for name, v in (("youden", rec + spec - 1), ("f2", 5 * prec * rec / (4 * prec + rec) if prec + rec else 0)):
            if v > best[name][0] + 1e-12:
                best[name] = (v, t)
    got = {r["threshold"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in ev.threshold_grid(df).collect()}
    assert got == cells
    for name, (value, t) in best.items():
        row = ev.best_threshold(df, name).first()
        assert row["threshold"] == t and np.isclose(row["value"], value)


def test_report_adds_up(spark):
    rows, df = make(spark)
    got = {r["name"]: r for r in ev.classification_report(df, 0.5).collect()}
    hits = sum((r[2] >= 0.5) == (r[1] == 1) for r in rows)
    assert np.isclose(got["accuracy"]["f1"], hits / len(rows))
    assert got["legit"]["support"] + got["fraud"]["support"] == len(rows) == got["macro avg"]["support"]


def test_stability_verdict(spark):
    def verdict(*ks):
        rows = [(d, 10, 0.5, k) for d, k in zip((14, 28, 56), ks)]
        found = ev.stability_trend(spark.createDataFrame(rows, "window_days int, n int, auc_pr double, ks double"))
        return [r["trend"] for r in found.collect()]
    assert verdict(0.5, 0.9, 0.4) == ["drops"]
    assert verdict(0.5, 0.1, 0.5) == ["stable/improves"]
    assert verdict(0.5) == []


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_split_heavy_stretches(spark, descending):
    draw = random.Random(5)
    values = sorted({draw.random() * 1e-6 for _ in range(900)} | {draw.random() for _ in range(50)})
    rows = [(g, v, draw.randrange(5)) for g in ("a", "b") for v in values]
    df = spark.createDataFrame(rows, "g string, v double, n bigint").repartition(5)
    out = running_totals(df, "v", ["n"], ["g"], descending, buckets=16)
    got = {(r["g"], r["v"]): (r["cum_n"], r["total_n"]) for r in out.collect()}
    for g in ("a", "b"):
        mine = sorted([r for r in rows if r[0] == g], key=lambda r: r[1], reverse=descending)
        total, running = sum(r[2] for r in mine), 0
        for r in mine:
            running += r[2]
            assert got[g, r[1]] == (running, total)


@pytest.mark.parametrize("n,accuracy", [(1, 100), (2, 100), (5, 100), (37, 100), (2500, 50), (2500, 10000)])
def test_exact_quantiles_against_numpy(spark, n, accuracy):
    draw = random.Random(n)
    data = [(draw.choice([0.0, 1.0, draw.random()]), draw.gauss(0, 1e6), None if draw.random() < 0.3 else draw.randrange(4), None)
            for _ in range(n)]
    df = spark.createDataFrame(data, "a double, b double, c int, d double").repartition(4)
    shares = [0.0, 0.5, 0.9, 0.99, 1.0]
    got = {(r["column"], r["share"]): r["value"] for r in exact_quantiles(df, list("abcd"), shares, accuracy).collect()}
    assert len(got) == 20
    for j, c in enumerate("abcd"):
        x = [r[j] for r in data if r[j] is not None]
        for s in shares:
            if x:
                assert np.isclose(got[c, s], np.quantile(x, s), rtol=1e-12, atol=1e-12), (c, s)
            else:
                assert got[c, s] is None


def test_tied_brackets_need_no_pass_over_the_rows(spark, monkeypatch):
    """A bracket of one value is known by its count; values of the others are counted once and written."""
    staged = []
    monkeypatch.setattr(quantiles, "stage", lambda df, name: staged.append(df) or stage(df, name))
    df = spark.range(5000).select(F.lit(-0.0).alias("zero"), (F.col("id") % 100 == 0).cast("int").alias("mark"), F.col("id").alias("id"))
    got = {r["column"]: r["value"] for r in exact_quantiles(df, ["zero", "mark"], [0.5]).collect()}
    assert got == {"zero": 0.0, "mark": 0.0} and not staged
    got = {r["column"]: r["value"] for r in exact_quantiles(df, ["zero", "mark", "id"], [0.5]).collect()}
    assert got == {"zero": 0.0, "mark": 0.0, "id": 2499.5} and len(staged) == 1
    assert [r[0] for r in staged[0].select("q").distinct().collect()] == [2]
