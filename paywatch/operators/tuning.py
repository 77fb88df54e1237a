"""Adaptive hyper-parameter search: a Parzen sampler proposes trials, rungs stop those that fall behind.

Trials of a batch run side by side, each in a scheduler pool of its own, over the same expanding time folds. A trial that goes on
to the next rung goes on with the trees it has (see `boosting.Boosting`), so no round is fitted twice. The driver only
holds one line per trial and rung.
"""

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.columns import LABEL, STRICT_FEATURES, TS
from paywatch.operators import boosting
from paywatch.operators.models import fit_preparation
from paywatch.operators.splits import fold_start_literals
from paywatch.session import stage

# Search ranges as (low, high, kind).
RANGES = {
    "rounds": (200, 800, "int"),
    "depth": (3, 8, "int"),
    "learning_rate": (0.02, 0.2, "log"),
    "subsample": (0.6, 1.0, "float"),
    "colsample": (0.6, 1.0, "float"),
    "min_child_weight": (1, 10, "int"),
    "gamma": (0.0, 1.0, "float"),
    "reg_lambda": (1.0, 5.0, "float"),
}
STARTUP = 10  # trials before the sampler looks at scores
CANDIDATES = 24
GOOD_SHARE = 0.1
MOST_GOOD = 25
RUNGS = (1 / 9, 1 / 3, 1.0)  # of a trial's rounds
KEEP = 1 / 3  # of a batch's trials go on to the next rung


@dataclass
class Trial:
    number: int
    values: dict
    score: float | None = None
    rung: int = -1
    rounds: int = 0


class ParzenSampler:
    """Proposes values of each parameter by itself: past trials are split into good and other ones, each kind gives a mixture of normal
    densities around its values, and of CANDIDATES draws from the good mixture the one with the largest ratio of densities wins.
    Both mixtures have a wide component in the middle of the range. The first STARTUP trials are drawn evenly."""

    def __init__(self, ranges=None, seed=settings.SEED, startup=STARTUP):
        self.ranges, self.startup = dict(RANGES if ranges is None else ranges), startup
        self.random = random.Random(seed)

    @staticmethod
    def _inner(x, kind):
        return math.log(x) if kind == "log" else float(x)

    def _outer(self, x, low, high, kind):
        x = math.exp(x) if kind == "log" else x
        x = min(max(x, low), high)
        return int(min(max(math.floor(x + 0.5), low), high)) if kind == "int" else x

    def propose(self, trials: list) -> dict:
        """Values for a new trial, after `trials`; those without a score don't count."""
        known = [t for t in trials if t.score is not None]
        order = sorted(known, key=lambda t: (-t.rung, -t.score, t.number))  # a trial that got further is better
        count = min(MOST_GOOD, math.ceil(GOOD_SHARE * len(order)))
        good, other = order[:count], order[count:]
        out = {}
        for name, (low, high, kind) in self.ranges.items():
            wide = (0.5, 0.5) if kind == "int" else (0, 0)  # whole numbers stand for the unit around them
            a, b = self._inner(low - wide[0], kind), self._inner(high + wide[1], kind)
            if len(known) < self.startup:
                out[name] = self._outer(self.random.uniform(a, b), low, high, kind)
                continue
            near, far = (mixture([self._inner(t.values[name], kind) for t in sorted(part, key=lambda t: t.number)], a, b)
                         for part in (good, other))
            draws = []
            for _ in range(CANDIDATES):
                center, spread = near[self.random.randrange(len(near))]
                x = self.random.gauss(center, spread)
                while not a <= x <= b:
                    x = self.random.gauss(center, spread)
                draws.append(x)
            out[name] = self._outer(max(draws, key=lambda x: density(near, x, a, b) - density(far, x, a, b)), low, high, kind)
        return out


def mixture(values: list, a: float, b: float) -> list:
    """(center, spread) of each component: one for each value, as wide as the larger distance to its neighbours, within bounds; and one
    as wide as the range in its middle."""
    centers = sorted([*values, (a + b) / 2])
    least = (b - a) / min(100.0, 1.0 + len(centers))
    out = []
    for i, c in enumerate(centers):
        left = c - (centers[i - 1] if i else a)
        right = (centers[i + 1] if i + 1 < len(centers) else b) - c
        out.append((c, min(max(left, right, least), b - a)))
    middle = centers.index((a + b) / 2)
    out[middle] = ((a + b) / 2, b - a)
    return out


def density(parts: list, x: float, a: float, b: float) -> float:
    """Logarithm of the mean of the components' densities, each cut off at the range."""
    total = 0.0
    for center, spread in parts:
        inside = 0.5 * (math.erf((b - center) / (spread * math.sqrt(2))) - math.erf((a - center) / (spread * math.sqrt(2))))
        total += math.exp(-0.5 * ((x - center) / spread)**2) / (spread * math.sqrt(2 * math.pi) * inside)
    return math.log(total / len(parts)) if total > 0 else -math.inf


def time_folds(train: DataFrame, features, folds=settings.CV_FOLDS, label=LABEL, ts=TS) -> list:
    """(prepared rows of a fold's past and block, kept columns, whether a row is of the block) of each fold whose past has both
    classes. Preparation is fitted on the past."""
    starts, out = fold_start_literals(train, folds, ts), []
    for i, start in enumerate(starts):
        rows = train if i + 1 == len(starts) else train.filter(F.col(ts) < starts[i + 1])
        past = rows.filter(F.col(ts) < start)
        if past.select(label).distinct().count() == 2:
            plan = fit_preparation(past, features)
            out.append((stage(plan.apply(rows), "fold"), plan.keep, F.col(ts) >= start))
    return out


class _Run:
    """One trial's training on all folds."""

    def __init__(self, folds, values, base, seed, label, ts):
        params = replace(base, **values)
        self.rounds = params.rounds
        self.parts = [boosting.Boosting(rows, keep, params, label, ts, seed, valid=valid, patience=params.rounds) for rows, keep, valid in folds]

    def up_to(self, share: float) -> tuple[float, int]:
        """Mean average precision of the blocks, and rounds, after that share of the rounds."""
        rounds = max(1, math.ceil(share * self.rounds))
        best = []
        for part in self.parts:
            part.run(rounds)
            best.append(part.model.history[-1][1] if part.model.history else 0.0)
        return sum(best) / len(best), rounds


def adaptive_search(train: DataFrame, features=STRICT_FEATURES, trials=settings.SEARCH_TRIALS, batch=6, folds=settings.CV_FOLDS,
                    ranges=None, base=boosting.NewtonParams(), rungs=RUNGS, keep=KEEP, seed=settings.SEED, label=LABEL, ts=TS,
                    startup=STARTUP):
    """(best parameters or None, [Trial], rounds fitted in all folds).

    Trials come in batches: all of a batch run up to the first rung, the best `keep` of them up to the next one, and so on. A
    trial's score is that of the last rung it reached. Without a fold whose past has both classes there is no score.
    """
    sampler, done, fitted = ParzenSampler(ranges, seed, startup), [], 0
    parts = time_folds(train, features, folds, label, ts)
    if not parts:
        return None, done, 0
    context = train.sparkSession.sparkContext

    def in_pool(trial, work):
        context.setLocalProperty("spark.scheduler.pool", f"trial-{trial.number}")
        return work()

    while len(done) < trials:
        group = [Trial(len(done) + i, sampler.propose(done)) for i in range(min(batch, trials - len(done)))]
        open_ = {t.number: (t, None) for t in group}
        for rung, share in enumerate(rungs):
            def advance(trial, run):
                run = run or _Run(parts, trial.values, base, seed, label, ts)
                return trial, run, run.up_to(share)

            with ThreadPoolExecutor(len(open_)) as pool:
                jobs = [pool.submit(inheritable_thread_target(train.sparkSession)(in_pool), t, lambda t=t, r=r: advance(t, r)) for t, r in open_.values()]
                results = [j.result() for j in jobs]
            for trial, run, (score, rounds) in results:
                fitted += len(parts) * (rounds - trial.rounds)
                trial.score, trial.rung, trial.rounds = score, rung, rounds
            results.sort(key=lambda r: (-r[0].score, r[0].number))
            open_ = {t.number: (t, run) for t, run, _ in results[:max(1, math.ceil(keep * len(results)))]}
        done += group
    best = max(done, key=lambda t: (t.rung, t.score, -t.number))
    return replace(base, **best.values), done, fitted


def as_table(spark, trials: list) -> DataFrame:
    """One row per trial: trial, rung, rounds, score and its values."""
    names = sorted(trials[0].values) if trials else []
    rows = [(t.number, t.rung, t.rounds, t.score, *[float(t.values[n]) for n in names]) for t in trials]
    return spark.createDataFrame(rows, ", ".join(["trial int, rung int, fitted_rounds int, score double", *[f"{n} double" for n in names]]))
