r"""Mixing sources to target weights by hash-threshold histograms.

A document's place in its source is a hash of its id and text. Words are summed by source and by the first bits of
the hash (a histogram of BUCKETS cells a source), which tells the cell in which a budget runs out; only the rows of that cell are
summed again by the next bits, until a cell holds rows of one place only. What lies before the place found is taken: a filter, without
any sort of documents. A source that the mix takes more than once has nested budgets: the second copy's documents are
among the first copy's.

All large tables are rows of numbers keyed by (source, cell of the hash), so that a source with a third of all rows spreads.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from paywatch.session import stage

# Fixed values of the contract.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
COPIES = 2

BITS = 12
LEVELS = 5  # of a hash of 60 bits
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _hash(*parts: Column) -> Column:
    """60 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _cell(level: int) -> Column:
    """Bits of a place: first those of the document's hash, then, for documents that repeat, those of the row's."""
    place = F.col("place") if level < LEVELS else F.col("again")
    return F.shiftright(place, BITS * (LEVELS - 1 - level % LEVELS)).bitwiseAND((1 << BITS) - 1)


def placed(docs: DataFrame, by: str) -> DataFrame:
    """doc_id, source, size, place, again (a hash that differs for rows that repeat)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("null")).alias("source"),
        words(F.col("text")).alias("size"),
        _hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text)).alias("place"))
    return stage(rows.withColumn("again", _hash(F.monotonically_increasing_id().cast("string"))), "mix-rows")


def sources(rows: DataFrame) -> DataFrame:
    """source, source_size, rank: the number of sources before it by code point, null last."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source") == "null", F.col("source")]  # others begin with an equals sign
    sums = sums.repartitionByRange(*order).sortWithinPartitions(*order)
    sums = stage(sums.withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    first = sums.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    first = first.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # a row for each partition
    return sums.join(F.broadcast(first), part == F.col("part")).select(
        "source", "source_size", (F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank"))


def targets(sums: DataFrame, weights=WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """source, source_size, target. Budgets follow the weights; what is above `copies` times a source's size is shared again by
    weight among the others until none is above: each round is one aggregate over the sources."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sums = stage(sums.select("source", "source_size", weight.alias("weight"),
                             (F.col("source_size") * F.lit(float(copies))).alias("most")), "mix-weights")
    total = (sums.agg(F.sum("source_size")).first()[0] or 0) * share
    level = full = None
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most") if level is not None else F.lit(False)
        row = sums.agg(F.sum(F.when(above, F.col("most"))).alias("taken"), F.sum(F.when(~above, F.col("weight"))).alias("weight"),
                       F.count(F.when(above, 1)).alias("full")).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (total - (row["taken"] or 0.0)) / row["weight"]
    level = 0.0 if level is None else level
    return sums.select("source", "source_size", F.least(F.col("weight") * F.lit(level), F.col("most")).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame, copies: int = COPIES) -> DataFrame:
    """source, copy, place, again: the first place that a copy doesn't take; null where it takes all.

    A row is taken while half of it is within the budget, so a budget is missed by half of the row at its end at most.
    """
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    budget = F.greatest(F.lit(0.0), F.least(F.col("target") - F.col("source_size") * (F.col("copy") - 1), F.col("source_size").cast("double")))
    asked = budgets.select("source", "source_size", "target", copy).select(
        "source", "copy", budget.alias("budget"), (budget >= F.col("source_size")).alias("all"))
    ends = asked.where("all").select("source", "copy", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("again"))
    asked = asked.where("not all").select("source", "copy", "budget", F.lit(0.0).alias("before"))
    left = rows.select("source", "size", "place", "again").where("size > 0")
    keys = ["source"]
    for level in range(2 * LEVELS):
        cell = f"cell{level}"
        left = left.withColumn(cell, _cell(level))
        sums = left.groupBy(*keys, cell).agg(
            F.sum("size").alias("size"), F.min(F.struct("place", "again")).alias("low"), F.max(F.struct("place", "again")).alias("high"))
        sums = stage(sums, "mix-histogram")
        # One row for each cell of a source, BUCKETS at most, whatever its number of documents.
        upto = Window.partitionBy(*keys).orderBy(cell)
        sums = sums.withColumn("upto", F.sum("size").over(upto))
        found = asked.join(sums, keys).where(F.col("before") + F.col("upto") > F.col("budget"))
        found = found.groupBy("copy", *keys, "budget", "before").agg(F.min_by(
            F.struct(cell, "size", "upto", "low", "high"), cell).alias("at"))
        found = found.select("copy", *keys, "budget", f"at.{cell}", "at.size", "at.low", "at.high",
                             (F.col("before") + F.col("at.upto") - F.col("at.size")).alias("before"))
        found = stage(found, "mix-boundary")
        # One place in the cell, or bits are used up: the row goes to the nearer side.
        single = F.col("low") == F.col("high")
        within = 2 * F.col("before") + F.col("size") <= 2 * F.col("budget")
        end = F.when(within, F.struct(F.col("low.place").alias("place"), (F.col("low.again") + 1).alias("again"))).otherwise(F.col("low"))
        ends = ends.union(found.where(single).select("source", "copy", end["place"].alias("place"), end["again"].alias("again")))
        keys = [*keys, cell]
        asked = found.where(~single).select("copy", *keys, "budget", "before")
        if asked.isEmpty():
            break
        left = stage(left.join(asked.select(*keys).distinct(), keys, "left_semi"), "mix-refined")
    return stage(ends, "mix-thresholds")


def mix(docs: DataFrame, by: str = "source", weights=WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken.

    `taken` is `size` times the copies that the mix takes of the document, 0 to `copies`. A source's sum misses its target by half
    of one document at most. Null and empty texts have size 0. A null source is a source of its own and the last one. Rows that
    repeat id and text are told apart by a hash of the row; which of them are taken doesn't matter, how many is the same in each run.
    The same table gives the same mix, however it is partitioned. Without any word all targets are 0. Other columns are ignored; an
    empty table gives none.
    """
    rows = placed(docs, by)
    budgets = stage(targets(sources(rows), weights, share, copies), "mix-targets")
    ends = thresholds(rows, budgets, copies)
    # A row for each source and cell of the first level: rows of a large source find their thresholds in as many places.
    ends = ends.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("copy", "place", "again"))).alias("ends"))  # one for each copy
    cells = rows.groupBy("source", _cell(0).alias("cell")).agg(F.lit(1).alias("one")).drop("one")
    cells = cells.join(budgets, "source").join(ends, "source")
    here = F.struct("place", "again")
    taken = F.aggregate("ends", F.lit(0).cast("long"), lambda s, e: s + F.when(
        e["place"].isNull() | (here < F.struct(e["place"], e["again"])), 1).otherwise(0))
    out = rows.withColumn("cell", _cell(0)).join(cells, ["source", "cell"])
    name = F.when(F.col("source") != "null", F.substring("source", 2, 1 << 30))
    return out.select("doc_id", "size", name.alias("source"), "source_size", "target", (F.col("size") * taken).alias("taken"))
