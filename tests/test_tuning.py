"""The sampler against a plain version, and a search that stops trials early."""

import math
import random

import pytest
from pyspark.sql import functions as F

from paywatch.operators import tuning
from paywatch.operators.boosting import NewtonParams
from paywatch.operators.tuning import ParzenSampler, Trial, adaptive_search
from tests.test_boosting import COLUMNS, data

RANGES = {"depth": (2, 6, "int"), "learning_rate": (0.05, 0.5, "log"), "subsample": (0.5, 1.0, "float")}


def plain_proposal(rng, trials, ranges, startup):
    scored = sorted((t for t in trials if t.score is not None), key=lambda t: (-t.rung, -t.score, t.number))
    cut = min(25, math.ceil(len(scored) / 10))
    out = {}
    for name, (low, high, kind) in ranges.items():
        to = math.log if kind == "log" else float
        a, b = (to(low - 0.5), to(high + 0.5)) if kind == "int" else (to(low), to(high))

        def back(x):
            x = min(max(math.exp(x) if kind == "log" else x, low), high)
            return int(min(max(math.floor(x + 0.5), low), high)) if kind == "int" else x

        if len(scored) < startup:
            out[name] = back(rng.uniform(a, b))
            continue

        def components(part):
            values = [to(t.values[name]) for t in part]
            points = sorted(values + [(a + b) / 2])
            found, seen = [], False
            for i, c in enumerate(points):
                if c == (a + b) / 2 and not seen:
                    found.append((c, b - a))
                    seen = True
                else:
                    gaps = [c - (points[i - 1] if i > 0 else a), (points[i + 1] if i < len(points) - 1 else b) - c]
                    found.append((c, min(b - a, max(*gaps, (b - a) / min(100, 1 + len(points))))))
            return found

        def log_density(parts, x):
            normal = lambda y: 0.5 * (1 + math.erf(y / math.sqrt(2)))
            each = [math.exp(-((x - c) / s)**2 / 2) / s / math.sqrt(2 * math.pi) / (normal((b - c) / s) - normal((a - c) / s)) for c, s in parts]
            return math.log(sum(each) / len(each))

        good, other = components(scored[:cut]), components(scored[cut:])
        best = None
        for _ in range(24):
            c, s = good[rng.randrange(len(good))]
            x = rng.gauss(c, s)
            while x < a or x > b:
                x = rng.gauss(c, s)
            ratio = log_density(good, x) - log_density(other, x)
            if best is None or ratio > best[0]:
                best = (ratio, x)
        out[name] = back(best[1])
    return out


def test_sampler_against_plain():
    rng, sampler, trials = random.Random(7), ParzenSampler(RANGES, 7, startup=5), []
    for n in range(40):
        found = sampler.propose(trials)
        want = plain_proposal(rng, trials, RANGES, 5)
        assert found.keys() == want.keys()
        for name, (low, high, kind) in RANGES.items():
            assert found[name] == pytest.approx(want[name], rel=1e-9) and low <= found[name] <= high
            assert isinstance(found[name], int) == (kind == "int")
        score = None if n % 9 == 8 else -(math.log(found["learning_rate"]) - math.log(0.2))**2 - abs(found["depth"] - 4)
        trials.append(Trial(n, found, score, n % 3))


def test_sampler_finds_good_values():
    sampler, trials = ParzenSampler(RANGES, 3), []
    for n in range(60):
        values = sampler.propose(trials)
        trials.append(Trial(n, values, -(math.log(values["learning_rate"] / 0.1))**2 - (values["depth"] - 5)**2, 0))
    early, late = trials[:10], trials[40:]
    mean = lambda part: sum(t.score for t in part) / len(part)
    assert mean(late) > mean(early)


def test_search_stops_bad_trials_and_fits_fewer_rounds(spark):
    rows = spark.createDataFrame(data(400), "tx_id long, event_timestamp long, is_laundering int, a double, b double, c double")
    ranges = {"rounds": (4, 9, "int"), "learning_rate": (0.02, 0.6, "log")}
    base = NewtonParams(depth=2, bins=8, gamma=0.0, min_child_weight=0.5, subsample=1.0, colsample=1.0)
    best, trials, fitted = adaptive_search(rows, COLUMNS, trials=3, batch=3, folds=2, ranges=ranges, base=base, startup=3)
    assert [t.number for t in trials] == [0, 1, 2] and sorted(t.rung for t in trials) == [0, 0, 2]
    assert fitted == 2 * sum(t.rounds for t in trials) < 2 * sum(t.values["rounds"] for t in trials)
    top = max(trials, key=lambda t: t.rung)
    assert top.rounds == top.values["rounds"] == best.rounds and best.learning_rate == top.values["learning_rate"]
    table = tuning.as_table(spark, trials)
    assert table.columns[:4] == ["trial", "rung", "fitted_rounds", "score"] and table.where(F.col("score").between(0, 1)).count() == 3
    one = rows.withColumn("is_laundering", F.lit(0))
    assert adaptive_search(one, COLUMNS, trials=1, ranges=ranges, base=base) == (None, [], 0)
