"""Exact and approximate quantiles of many columns."""

from pyspark.sql import DataFrame, functions as F

from paywatch.operators.running_totals import running_totals
from paywatch.session import stage

ACCURACY = 10_000
BRACKETS = 1_000  # of sketches that only bracket an exact value: one task merges those of all tasks, and its work follows their size


def approximate_quantiles(df: DataFrame, columns, shares, accuracy=ACCURACY) -> DataFrame:
    """(column, share, value) where value is an element whose rank is off by at most rows/accuracy."""
    row = df.agg(*[F.percentile_approx(c, list(shares), accuracy).alias(c) for c in columns])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("share"), F.col(f"`{c}`")[i].cast("double").alias("value"))
        for c in columns for i, s in enumerate(shares)
    ])).alias("q")).select("q.*")


def _in_batches(items, size=8):
    return [items[i:i + size] for i in range(0, len(items), size)]


def _one_row(df: DataFrame, columns, aggregates) -> dict:
    """Aggregates of each column, a few columns a pass so that generated code stays small. `aggregates` gives
    {name: aggregate} of a column."""
    found = {}
    for batch in _in_batches(list(columns)):
        row = df.agg(*[a.alias(f"{c}::{n}") for c in batch for n, a in aggregates(c).items()]).first()
        found.update({c: {n: row[f"{c}::{n}"] for n in aggregates(c)} for c in batch})
    return found


def exact_quantiles(df: DataFrame, columns, shares, accuracy=ACCURACY) -> DataFrame:
    """(column, share, value) with linear interpolation between neighbours; nulls are ignored and a
    column without values gives null.

    Sketches bracket each quantile. Another pass counts what lies below and inside the brackets; where
    one misses, all are widened and counted again. Only values inside brackets, about 4/accuracy of
    them, are then grouped and ranked. No column is sorted or held whole. The driver sees one row.
    """
    columns, shares = list(columns), [float(s) for s in shares]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    margin = 2.0 / accuracy
    while True:
        asks = [(c, i, s) for c in columns for i, s in enumerate(shares)]
        facts = _bracketed(numbers, columns, shares, margin, accuracy)
        if margin >= 1 or all(_holds(facts[c], i, s) for c, i, s in asks):
            break
        margin *= 8
    asks = [(q, c, i, s) for q, (c, i, s) in enumerate(asks) if facts[c]["n"]]

    # A bracket of one value is known by its count; the others' values are read once and their counts written.
    wide = [(q, c, i) for q, c, i, _ in asks if facts[c][f"low{i}"] != facts[c][f"high{i}"]]
    inside = df.sparkSession.createDataFrame([
        (q, facts[c][f"low{i}"] + 0.0, facts[c][f"inside{i}"]) for q, c, i, _ in asks if facts[c][f"low{i}"] == facts[c][f"high{i}"]],
        "q int, x double, rows long")
    if wide:
        hits = F.array(*[
            F.when((F.col(c) >= facts[c][f"low{i}"]) & (F.col(c) <= facts[c][f"high{i}"]),
                   F.struct(F.lit(q).alias("q"), F.col(c).alias("x")))
            for q, c, i in wide
        ])
        counted = numbers.select(F.inline(F.array_compact(hits))).groupBy("q", "x").agg(F.count("*").alias("rows"))
        inside = stage(counted, "quantile_values").unionByName(inside)
    known = df.sparkSession.createDataFrame(
        [(q, c, s, (facts[c]["n"] - 1) * s, facts[c][f"below{i}"], facts[c][f"previous{i}"], facts[c][f"next{i}"])
         for q, c, i, s in asks],
        "q int, column string, share double, position double, below long, previous double, next double")

    ranked = running_totals(inside, "x", ["rows"], by=["q"])
    floor, upto, x = F.floor("position"), F.col("below") + F.col("cum_rows"), F.col("x")
    found = ranked.join(F.broadcast(known), "q").groupBy("column", "share").agg(
        F.min(F.when(upto > floor, x)).alias("at"), F.min(F.when(upto > floor + 1, x)).alias("after"),
        *[F.first(c).alias(c) for c in ("position", "below", "previous", "next")],
    )
    lower = F.when(floor < F.col("below"), F.col("previous")).otherwise(F.coalesce("at", "next"))
    upper = F.when(floor + 1 < F.col("below"), F.col("previous")).otherwise(F.coalesce("after", "next", "at"))
    answers = found.select("column", "share", (lower + (upper - lower) * (F.col("position") - floor)).alias("value"))
    asked = df.sparkSession.createDataFrame([(c, s) for c in columns for s in shares], "column string, share double")
    return asked.join(F.broadcast(answers), ["column", "share"], "left")


def _bracketed(numbers: DataFrame, columns, shares, margin, accuracy) -> dict:
    """{column: n, and per share: low, high, rows below and inside, nearest values outside}."""
    bounds = [max(0.0, min(1.0, s + d)) for s in shares for d in (-margin, margin)]
    sketches = _one_row(numbers, columns, lambda c: {"b": F.percentile_approx(c, bounds, accuracy),
                                                     "min": F.min(c), "max": F.max(c)})

    def edges(c, i):
        if margin >= 1:
            return sketches[c]["min"], sketches[c]["max"]
        return sketches[c]["b"][2 * i], sketches[c]["b"][2 * i + 1]

    def counts(c):
        out, x = {"n": F.count(c)}, F.col(c)
        for i in range(len(shares) if sketches[c]["b"] else 0):
            low, high = map(F.lit, edges(c, i))
            out |= {f"below{i}": F.count_if(x < low), f"inside{i}": F.count_if((x >= low) & (x <= high)),
                    f"previous{i}": F.max(F.when(x < low, x)), f"next{i}": F.min(F.when(x > high, x))}
        return out

    facts = _one_row(numbers, columns, counts)
    for c in columns:
        for i in range(len(shares) if sketches[c]["b"] else 0):
            facts[c][f"low{i}"], facts[c][f"high{i}"] = edges(c, i)
    return facts


def _holds(fact: dict, i: int, share: float) -> bool:
    """Whether both neighbours of a quantile lie inside its bracket or next to it."""
    if not fact["n"]:
        return True
    floor = int((fact["n"] - 1) * share)
    return fact[f"below{i}"] - 1 <= floor and floor + 1 <= fact[f"below{i}"] + fact[f"inside{i}"]


def medians(df: DataFrame, columns) -> DataFrame:
    """(column, value): exact medians; null for a column without values."""
    return exact_quantiles(df, columns, [0.5], BRACKETS).select("column", "value")
