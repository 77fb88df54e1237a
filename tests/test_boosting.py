"""Second-order boosted trees against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paywatch.operators import boosting
from paywatch.operators.boosting import BoostedTrees, Boosting, NewtonParams, fit_newton_trees

COLUMNS = ["a", "b", "c"]


def data(n=600, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), float(rng.randrange(5)), rng.random()
        p = 1 / (1 + math.exp(-(2 * a + (b - 2) * (c - 0.5) * 4 - 1.5)))
        out.append((i, i // 3, int(rng.random() < p), a, b, c))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(data(), "tx_id long, event_timestamp long, is_laundering int, a double, b double, c double").repartition(5)


def plain_trees(rows, params, seed=42, weight=None):
    """One row after another, one candidate split after another."""
    rows = [(boosting_key(i, seed), y, [a, b, c]) for i, _, y, a, b, c in rows]
    pos = sum(y for _, y, _ in rows)
    weight = (len(rows) - pos) / pos if weight is None else weight
    edges = []
    for f in range(3):
        values = sorted(x[f] for _, _, x in rows)
        picks = {values[max(1, -(-k * len(values) // params.bins)) - 1] for k in range(1, params.bins)}
        edges.append(sorted(v for v in picks if v < values[-1]))
    bins = [[sum(e < x[f] for e in edges[f]) for f in range(3)] for _, _, x in rows]
    margin, trees = [0.0] * len(rows), []
    for turn in range(params.rounds):
        g, h = [], []
        for (_, y, _), m in zip(rows, margin):
            w, p = weight if y else 1.0, 1 / (1 + math.exp(-m))
            g.append(round(w * (p - y) * 2**24))
            h.append(round(w * p * (1 - p) * 2**24))
        factor = (6364136223846793005 * (2 * turn + 1)) % 2**60
        draw = [(k * factor) % 2**60 / 2**60 for k, _, _ in rows]
        if params.top_share is not None:
            sizes = sorted((float(np.float32(abs(x))) for x in g), reverse=True)
            least = sizes[math.ceil(params.top_share * len(sizes)) - 1]
            share = params.other_share / (1 - params.top_share)
            use = []
            for i in range(len(rows)):
                if float(np.float32(abs(g[i]))) > least:
                    use.append(i)
                elif draw[i] < share:
                    use.append(i)
                    g[i], h[i] = round(g[i] / share), round(h[i] / share)
        else:
            use = [i for i in range(len(rows)) if params.subsample >= 1 or draw[i] < params.subsample]
        order = sorted(range(3), key=lambda f: ((((f + 1) * 0x9E3779B97F4A7C1 % 2**60) * (
            (6364136223846793005 * (2 * (turn + seed) + 1)) % 2**60)) % 2**60, f))
        features = sorted(order[:max(1, round(params.colsample * 3))])

        def best(members):
            total = [sum(x[i] for i in members) / 2**24 for x in (g, h)]
            found = None
            for f in features:
                for b in sorted({bins[i][f] for i in members}):
                    left = [i for i in members if bins[i][f] <= b]
                    right = [i for i in members if bins[i][f] > b]
                    lg, lh = (sum(x[i] for i in left) / 2**24 for x in (g, h))
                    rg, rh = total[0] - lg, total[1] - lh
                    lam = params.reg_lambda
                    term = lambda x, y: x * x / (y + lam) if y + lam > 0 else 0.0
                    gain = term(lg, lh) + term(rg, rh) - term(*total)
                    if right and gain > params.gamma and min(lh, rh) >= params.min_child_weight and (found is None or gain > found[0]):
                        found = (gain, f, b, left, right, (lg, lh), (rg, rh))
            return found

        value = lambda x, y: -x / (y + params.reg_lambda) if y + params.reg_lambda > 0 else 0.0
        nodes = [dict(f=-1, members=use, depth=0, value=value(sum(g[i] for i in use) / 2**24, sum(h[i] for i in use) / 2**24), gain=0.0)]

        def split(n):
            s = nodes[n]["best"]
            nodes[n].update(f=s[1], b=s[2], gain=s[0], left=len(nodes))
            for members, (x, y) in ((s[3], s[5]), (s[4], s[6])):
                nodes.append(dict(f=-1, members=members, depth=nodes[n]["depth"] + 1, value=value(x, y), gain=0.0))

        if params.leaves:
            nodes[0]["best"] = best(use)
            while sum(n["f"] < 0 for n in nodes) < params.leaves:
                open_ = [i for i, n in enumerate(nodes) if n["f"] < 0 and n.get("best")]
                if not open_:
                    break
                at = max(open_, key=lambda i: (nodes[i]["best"][0], -i))
                split(at)
                for n in nodes[-2:]:
                    n["best"] = best(n["members"]) if n["depth"] < params.depth else None
        else:
            level = [0]
            for _ in range(params.depth):
                following = []
                for n in level:
                    nodes[n]["best"] = best(nodes[n]["members"])
                    if nodes[n]["best"]:
                        split(n)
                        following += [len(nodes) - 2, len(nodes) - 1]
                level = following
        if len(nodes) == 1:
            break
        trees.append(nodes)
        for i in range(len(rows)):
            n = nodes[0]
            while n["f"] >= 0:
                n = nodes[n["left"] + (bins[i][n["f"]] > n["b"])]
            margin[i] += params.learning_rate * n["value"]
    return trees, margin, edges


def boosting_key(i, seed):
    import hashlib
    return int(hashlib.md5(f"{i}:{seed}".encode()).hexdigest()[:15], 16)


CASES = [
    NewtonParams(rounds=3, depth=3, subsample=1.0, colsample=1.0, bins=8, min_child_weight=2.0, exact_edges=True),
    NewtonParams(rounds=3, depth=2, subsample=0.6, colsample=0.7, bins=16, gamma=0.0, reg_lambda=1.0, exact_edges=True),
    NewtonParams(rounds=3, depth=6, leaves=6, subsample=1.0, colsample=1.0, bins=8, min_child_weight=1.0, gamma=0.0, exact_edges=True),
    NewtonParams(rounds=4, depth=4, leaves=9, top_share=0.2, other_share=0.3, colsample=1.0, bins=8, min_child_weight=1.0, gamma=0.0,
                 reg_lambda=0.0, exact_edges=True),
]


@pytest.mark.parametrize("params", CASES)
def test_trees_against_plain(spark, rows, params):
    model = fit_newton_trees(rows, COLUMNS, params, early_stopping=False)
    trees, margin, edges = plain_trees(data(), params)
    for found, want in zip(model.edges, edges):
        assert found.tolist() == want
    assert len(model.trees) == len(trees)
    for tree, nodes in zip(model.trees, trees):
        assert tree.feature == [n["f"] for n in nodes]
        assert tree.bin == [n.get("b", -1) for n in nodes] and tree.rows == [len(n["members"]) for n in nodes]
        np.testing.assert_allclose(tree.value, [n["value"] for n in nodes], rtol=1e-12)
        np.testing.assert_allclose(tree.gain, [n["gain"] for n in nodes], rtol=1e-9)
    scored = {r.tx_id: r for r in model.score(rows, margin="margin").collect()}
    for (i, *_), m in zip(data(), margin):
        assert scored[i].margin == pytest.approx(m) and scored[i].score == pytest.approx(1 / (1 + math.exp(-m)))


def test_trees_do_not_depend_on_partitions(spark, rows):
    params = NewtonParams(rounds=2, depth=3, bins=8, exact_edges=True)
    first = fit_newton_trees(rows, COLUMNS, params, early_stopping=False)
    second = fit_newton_trees(rows.repartition(11, "b"), COLUMNS, params, early_stopping=False)
    assert [vars(t) for t in first.trees] == [vars(t) for t in second.trees]


def test_early_stopping_fits_no_more_rounds_than_it_must(spark, rows, monkeypatch):
    calls = []
    grow = Boosting._tree
    monkeypatch.setattr(Boosting, "_tree", lambda self, *a: calls.append(1) or grow(self, *a))
    params = NewtonParams(rounds=200, depth=3, learning_rate=0.8, bins=16, gamma=0.0, min_child_weight=0.5)
    model = fit_newton_trees(rows, COLUMNS, params, patience=4)
    assert model.fitted_rounds == len(calls) == model.best_round + 4 < 200
    assert len(model.trees) == model.best_round and len(model.history) == len(calls)
    best = max(s for _, s in model.history)
    assert dict(model.history)[model.best_round] == best
    # The score is the average precision of the latest fifth.
    start = rows.agg(F.max("event_timestamp")).first()[0]
    late = [r for r in model.score(rows).collect() if r.event_timestamp >= start * 4 // 5 + 1]
    late.sort(key=lambda r: -r.score)
    hits, total = 0, 0.0
    for k, r in enumerate(late, 1):
        hits += r.is_laundering
        total += r.is_laundering * hits / k
    assert abs(total / hits - best) < 0.05


def test_training_goes_on_where_it_stopped(spark, rows):
    params = NewtonParams(rounds=12, depth=2, bins=8)  # beyond the round in which margins are written
    whole = fit_newton_trees(rows, COLUMNS, params, early_stopping=False)
    parts = Boosting(rows, COLUMNS, params, early_stopping=False)
    parts.run(3)
    parts.run(11)
    assert [vars(t) for t in parts.run().trees] == [vars(t) for t in whole.trees] and len(whole.trees) == 12


def test_saved_trees_score_alike(spark, rows, tmp_path):
    model = fit_newton_trees(rows, COLUMNS, NewtonParams(rounds=3, depth=3, bins=8), early_stopping=False)
    model.save(spark, str(tmp_path / "m"))
    again = BoostedTrees.load(spark, str(tmp_path / "m"))
    key = lambda df: sorted((r.tx_id, r.score) for r in df.collect())
    assert key(again.score(rows)) == key(model.score(rows))
    gains = {r.feature: r for r in boosting.feature_gain(model.nodes(spark)).collect()}
    each = [(t.feature[i], t.gain[i]) for t in model.trees for i in range(len(t.feature)) if t.feature[i] >= 0]
    for f, name in enumerate(COLUMNS):
        mine = [g for x, g in each if x == f]
        assert (gains[name].splits, round(gains[name].total_gain, 6)) == (len(mine), round(sum(mine), 6)) if mine else name not in gains


def test_odd_training_rows(spark):
    schema = "tx_id long, event_timestamp long, is_laundering int, a double, b double, c double"
    one = spark.createDataFrame([(i, i, 0, 1.0, float(i), 0.0) for i in range(20)], schema)
    model = fit_newton_trees(one, COLUMNS, NewtonParams(rounds=3, min_child_weight=0.0))
    assert all(r.score <= 0.5 for r in model.score(one).collect()) and model.score(one).count() == 20
    same = spark.createDataFrame([(i, 5, i % 2, 1.0, 1.0, 1.0) for i in range(20)], schema)
    model = fit_newton_trees(same, COLUMNS, NewtonParams(rounds=3))
    assert model.trees == [] and {r.score for r in model.score(same).collect()} == {0.5}


def test_leafwise_ap_is_near_the_first_model(spark, rows):
    from paywatch.operators.evaluation import average_precision
    from paywatch.operators.models import as_scores
    train, test = rows.where("tx_id % 4 <> 0"), rows.where("tx_id % 4 = 0")
    level = fit_newton_trees(train, COLUMNS, NewtonParams(rounds=8, depth=3, bins=32, min_child_weight=1.0), early_stopping=False)
    leaf = fit_newton_trees(train, COLUMNS, NewtonParams(rounds=8, depth=6, leaves=8, top_share=0.2, other_share=0.2, bins=32,
                                                         min_child_weight=1.0), early_stopping=False)
    found = [average_precision(as_scores(m.score(test))).first()["auc_pr"] for m in (level, leaf)]
    assert found[1] >= found[0] - 0.02
