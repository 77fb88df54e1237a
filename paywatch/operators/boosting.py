"""Second-order boosted trees on binned features.

Training rows are binned once (quantile edges) and kept as one table: a hash of the id, label, weight, whether the row is for
validation, its bins and its margin. Each level of a tree is one pass: every task sums gradients and hessians of its rows by node, feature
and bin, Spark adds these histograms up, and the best split of each node is found in them. Only the winning splits, one row for each
open node, reach the driver. Margins of finished trees are added on the fly and written out every `WRITE_EVERY` rounds,
so no pass depends on a long chain of others.

Sums are of whole numbers (gradients in units of 2 ** -24), so they don't depend on partitions or on their order: the same rows give
the same trees anywhere, also after lost executors.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paywatch import settings
from paywatch.columns import LABEL, TS
from paywatch.operators.quality import class_weights
from paywatch.operators.running_totals import running_totals
from paywatch.operators.splits import fold_start_literals
from paywatch.session import package_on_workers, stage

UNIT = 1 << 24  # gradients are whole multiples of 1 / UNIT
KEY_BITS = 60
WRITE_EVERY = 10
SCORE_CELLS = 8192  # of margins between -16 and 16: the curve of the validation rows
AHEAD = 4  # leaves whose children are summed in the same pass when a tree grows leaf by leaf


@dataclass(frozen=True)
class NewtonParams:
    """The defaults used when no search is run."""

    rounds: int = 400
    depth: int = 5
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    min_child_weight: float = 5.0
    gamma: float = 0.5
    reg_lambda: float = 2.0
    bins: int = 64
    leaves: int | None = None  # grow leaf by leaf, the best first, up to so many
    top_share: float | None = None  # with `other_share`: all rows with large gradients and a sample of the others
    other_share: float = 0.1
    exact_edges: bool = False  # of the bins; from sketches otherwise


@dataclass
class Tree:
    """Nodes in the order in which they were made; node 0 is the root. A row goes left where its bin is at most `bin`."""

    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [-1])
    left: list = field(default_factory=lambda: [-1])
    gain: list = field(default_factory=lambda: [0.0])
    value: list = field(default_factory=lambda: [0.0])
    hessian: list = field(default_factory=lambda: [0.0])
    rows: list = field(default_factory=lambda: [0])
    depth: list = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, at: int, gain: float, sides) -> int:
        """Gives `node` two children; `sides` has value, hessian and rows of each. Returns the left child, the right one follows."""
        self.feature[node], self.bin[node], self.gain[node], self.left[node] = feature, at, gain, len(self.feature)
        for value, hessian, rows in sides:
            for name, x in (("feature", -1), ("bin", -1), ("left", -1), ("gain", 0.0), ("value", value), ("hessian", hessian),
                            ("rows", rows), ("depth", self.depth[node] + 1)):
                getattr(self, name).append(x)
        return self.left[node]

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node at which each row ends."""
        feature, at, left = (np.array(x) for x in (self.feature, self.bin, self.left))
        node = np.zeros(len(bins), np.int64)
        for _ in range(max(self.depth)):
            f = feature[node]
            inner = f >= 0
            right = bins[np.arange(len(bins)), np.maximum(f, 0)] > at[node]
            node = np.where(inner, left[node] + right, node)
        return node

    def values_of(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(bins)]


@dataclass
class BoostedTrees:
    """Trees, the edges of the bins, and how training went."""

    columns: list
    edges: list
    trees: list
    learning_rate: float
    history: list = field(default_factory=list)  # (round, score on validation rows)
    fitted_rounds: int = 0
    best_round: int | None = None

    def binned(self, numbers: list) -> np.ndarray:
        return np.stack([np.searchsorted(e, x, side="left") for e, x in zip(self.edges, numbers)], axis=1).astype(np.uint8)

    def score(self, df: DataFrame, output: str = "score", margin: str | None = None) -> DataFrame:
        """Adds `score`, the probability of the positive class. Columns must have no nulls."""
        name = "_margin"
        numbers = F.array(*[F.col(f"`{c}`").cast("double") for c in self.columns])
        rows = df.withColumn("_numbers", numbers)
        package_on_workers(df.sparkSession)
        scored = rows.mapInArrow(_margins(self, name), _with(df, name, "double"))
        out = scored.withColumn(output, 1 / (1 + F.exp(-F.col(name))))
        return (out.withColumn(margin, F.col(name)) if margin else out).drop(name)

    def nodes(self, spark) -> DataFrame:
        """One row per node: tree, node, depth, feature, threshold, left, right, gain, value, hessian, rows."""
        rows = []
        for t, tree in enumerate(self.trees):
            for i, f in enumerate(tree.feature):
                inner = f >= 0
                rows.append((t, i, tree.depth[i], self.columns[f] if inner else None,
                             float(self.edges[f][tree.bin[i]]) if inner else None, tree.left[i] if inner else None,
                             tree.left[i] + 1 if inner else None, float(tree.gain[i]), float(tree.value[i]), float(tree.hessian[i]),
                             int(tree.rows[i])))
        return spark.createDataFrame(rows, NODES)

    def save(self, spark, path: str):
        """As two small tables: nodes and edges."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        rows = [(i, c, [float(x) for x in e], self.learning_rate) for i, (c, e) in enumerate(zip(self.columns, self.edges))]
        spark.createDataFrame(rows, "place int, feature string, edges array<double>, learning_rate double").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/edges")

    @classmethod
    def load(cls, spark, path: str) -> "BoostedTrees":
        edges = spark.read.parquet(f"{path}/edges").orderBy("place").collect()  # one row per feature
        columns, cuts = [r.feature for r in edges], [np.array(r.edges) for r in edges]
        trees = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # a row per node
            tree = trees.setdefault(r.tree, Tree([], [], [], [], [], [], [], []))
            f = -1 if r.feature is None else columns.index(r.feature)
            tree.feature.append(f)
            tree.bin.append(-1 if f < 0 else int(np.searchsorted(cuts[f], r.threshold)))
            tree.left.append(-1 if f < 0 else r.left)
            for name in ("gain", "value", "hessian", "rows", "depth"):
                getattr(tree, name).append(r[name])
        return cls(columns, cuts, [trees[t] for t in sorted(trees)], edges[0].learning_rate if edges else 0.0)


NODES = ("tree int, node int, depth int, feature string, threshold double, `left` int, `right` int, gain double, value double, "
         "hessian double, rows long")
STATE = "key long, label int, weight double, valid boolean, bins binary, margin double"
SUMS = "slot int, feature int, bin int, g long, h long, n long"


def _with(df: DataFrame, name: str, kind: str) -> str:
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], f"`{name}` {kind}"])


def _numbers(batch: pa.RecordBatch, many: int) -> list:
    flat = batch.column("_numbers").flatten().to_numpy(zero_copy_only=False)
    return list(np.ascontiguousarray(flat.reshape(-1, many).T))


def _margins(model: BoostedTrees, name: str):
    many = len(model.columns)

    def run(batches):
        for batch in batches:
            bins = model.binned(_numbers(batch, many)) if batch.num_rows else np.zeros((0, many), np.uint8)
            out = np.zeros(len(bins))
            for tree in model.trees:
                out += model.learning_rate * tree.values_of(bins)
            kept = [c for c in batch.schema.names if c != "_numbers"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out)], names=[*kept, name])

    return run


# Rows ---------------------------------------------------------------------------------------------------------------

def quantile_edges(df: DataFrame, columns, bins: int, exact: bool = False, accuracy: int = 10_000) -> list:
    """At most `bins` - 1 different values of each column that lie at equal shares of the rows; the largest value is none of them. From
    sketches in one pass, or exact: different values are counted, and ranks are running totals of the counts."""
    numbers = [F.col(f"`{c}`").cast("double") for c in columns]
    if exact:
        each = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("f"), x.alias("x")) for i, x in enumerate(numbers)])))
        values = stage(each.groupBy("f", "x").agg(F.count("*").alias("rows")), "edge_values")  # read three times below
        ranked = running_totals(values, "x", ["rows"], by=["f"])
        upto = F.expr(f"(cum_rows * {bins}) div total_rows")
        before = F.expr(f"((cum_rows - rows) * {bins}) div total_rows")
        rows = ranked.where((upto > before) & ((before < bins - 1) | (F.col("cum_rows") == F.col("total_rows")))).select("f", "x")
        found = [[] for _ in columns]
        for r in rows.collect():  # bins rows per column
            found[r.f].append(r.x)
    else:
        shares = [i / bins for i in range(1, bins)] + [1.0]
        row = df.agg(*[F.percentile_approx(x, shares, accuracy).alias(f"c{i}") for i, x in enumerate(numbers)]).first()
        found = [list(x or []) for x in row]  # bins numbers per column
    return [np.unique(np.array([x for x in values if x < max(values)], np.float64)) for values in found]


def draw_key(column: str = "tx_id", seed: int = settings.SEED) -> Column:
    """60 bits of an MD5 of id and seed."""
    text = F.concat_ws(":", F.col(column).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def draws(key: np.ndarray, turn: int) -> np.ndarray:
    """A number from 0 to 1 for each row and turn: the key times an odd number, modulo 2 ** 60."""
    factor = np.uint64((6364136223846793005 * (2 * turn + 1)) % (1 << KEY_BITS))
    return ((key.astype(np.uint64) * factor) & np.uint64((1 << KEY_BITS) - 1)) / float(1 << KEY_BITS)


def _binned(edges: list):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = _numbers(batch, len(edges))
            bins = np.stack([np.searchsorted(e, x, side="left") for e, x in zip(edges, numbers)], axis=1).astype(np.uint8)
            ends = np.arange(len(bins) + 1, dtype=np.int32) * len(edges)
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(ends), pa.py_buffer(bins.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("key", "label", "weight", "valid")], packed,
                 pa.array(np.zeros(batch.num_rows))], names=["key", "label", "weight", "valid", "bins", "margin"])

    return run


def _rows_of(batch: pa.RecordBatch, many: int):
    bins = batch.column("bins")
    begin, data = np.frombuffer(bins.buffers()[1], np.int32)[bins.offset], bins.buffers()[2]
    bins = np.frombuffer(data or b"", np.uint8)[begin:begin + len(bins) * many].reshape(-1, many)
    return bins, *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "label", "weight", "valid", "margin")]


def gradients(label: np.ndarray, weight: np.ndarray, margin: np.ndarray):
    """Of the logistic loss, in units of 1 / UNIT."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint(weight * (p - label) * UNIT).astype(np.int64), np.rint(weight * p * (1 - p) * UNIT).astype(np.int64)


class _Pass:
    """What a task does with each batch: margins so far, gradients, and which rows of this round count, with what factor."""

    def __init__(self, many, trees, rate, turn, params, threshold):
        self.many, self.trees, self.rate, self.turn, self.params, self.threshold = many, trees, rate, turn, params, threshold

    def rows(self, batch):
        bins, key, label, weight, valid, margin = _rows_of(batch, self.many)
        margin = margin.copy()
        for tree in self.trees:
            margin += self.rate * tree.values_of(bins)
        return bins, key, label, weight, valid, margin

    def gradients(self, batch):
        bins, key, label, weight, valid, margin = self.rows(batch)
        g, h = gradients(label, weight, margin)
        use = ~valid
        if self.params.top_share is not None:
            high = np.abs(g).astype(np.float32) > np.float32(self.threshold)
            other = self.params.other_share / (1 - self.params.top_share)
            chosen = ~high & (draws(key, self.turn) < other)
            factor = 1 / other
            g, h = (np.where(chosen, np.rint(x * factor).astype(np.int64), x) for x in (g, h))
            use &= high | chosen
        elif self.params.subsample < 1:
            use &= draws(key, self.turn) < self.params.subsample
        return bins[use], g[use], h[use]


def _histograms(work: _Pass, tree: Tree, slots: dict, features: list):
    """Sums by slot (an open node), feature and bin, one row for each that occurs in the task."""
    def run(batches):
        width, cells = 256, len(slots) * len(features) * 256
        sums = np.zeros((3, cells), np.int64)
        number = np.full(len(tree.feature), -1)
        number[list(slots)] = list(slots.values())
        place = np.arange(len(features)) * width
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, g, h = work.gradients(batch)
            slot = number[tree.nodes_of(bins)]
            here = slot >= 0
            if not here.any():
                continue
            at = (slot[here, None] * (len(features) * width) + place + bins[here][:, features]).ravel()
            for i, x in enumerate((g, h)):  # batches are small: their sums are exact in a double
                sums[i] += np.rint(np.bincount(at, np.repeat(x[here], len(features)).astype(np.float64), cells)).astype(np.int64)
            sums[2] += np.bincount(at, minlength=cells)
        at = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(
                (at // (len(features) * width), np.array(features)[at // width % len(features)], at % width, *sums[:, at]),
                (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            names=["slot", "feature", "bin", "g", "h", "n"])

    return run


def best_splits(sums: DataFrame, reg_lambda: float, min_child_weight: float, gamma: float) -> DataFrame:
    """slot, total_g, total_h, total_n and `best`: the split with the largest gain of each slot (of equal ones the lowest
    feature and bin); null where none gains more than `gamma` or children are too light."""
    sums = sums.groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"])
    part = Window.partitionBy("slot", "feature")
    upto = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    real = lambda c: F.col(c) / F.lit(float(UNIT))
    rows = sums.withColumns({f"left_{c}": F.sum(c).over(upto) for c in "ghn"} | {f"total_{c}": F.sum(c).over(part) for c in "ghn"})
    rows = rows.select("slot", "feature", "bin", *[real(f"{s}_{c}").alias(f"{s}_{c}") for s in ("left", "total") for c in "gh"],
                       "left_n", "total_n")
    rows = rows.withColumns({f"right_{c}": F.col(f"total_{c}") - F.col(f"left_{c}") for c in "ghn"})

    def term(side):
        weight = F.col(f"{side}_h") + F.lit(float(reg_lambda))
        return F.when(weight > 0, F.col(f"{side}_g") * F.col(f"{side}_g") / weight).otherwise(0.0)

    rows = rows.withColumn("gain", term("left") + term("right") - term("total"))
    allowed = (F.col("gain") > gamma) & (F.col("left_n") > 0) & (F.col("right_n") > 0) & (
        F.col("left_h") >= min_child_weight) & (F.col("right_h") >= min_child_weight)
    found = F.struct("gain", (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"),
                     *[f"{s}_{c}" for s in ("left", "right") for c in "ghn"])
    return rows.groupBy("slot").agg(*[F.max(f"total_{c}").alias(f"total_{c}") for c in "ghn"],
                                    F.max(F.when(allowed, found)).alias("best"))


def _value(g: float, h: float, reg_lambda: float) -> float:
    return -g / (h + reg_lambda) if h + reg_lambda > 0 else 0.0


def _top_gradients(work: _Pass, high_bits: int | None):
    """Counts of training rows by the upper half of their gradient's size, or by the lower half within one upper half."""
    def run(batches):
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            if batch.num_rows:
                _, _, label, weight, valid, margin = work.rows(batch)
                size = np.abs(gradients(label, weight, margin)[0][~valid]).astype(np.float32).view(np.uint32)
                if high_bits is not None:
                    size = size[size >> 16 == high_bits] & 0xFFFF
                else:
                    size = size >> 16
                counts += np.bincount(size, minlength=1 << 16)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["cell", "rows"])

    return run


def top_threshold(state: DataFrame, work: _Pass, share: float) -> float:
    """The gradient (in units, as a 32-bit float) that the wanted share of the rows reaches: sizes are counted by their upper
    16 bits, then, within the cell where the share ends, by their lower 16. Only rows above it are kept whole: those that tie with it
    may be nearly all rows (in the first round), and are drawn like the others."""
    want, high = None, None
    for _ in range(2):
        found = state.mapInArrow(_top_gradients(work, high), "cell int, rows long").groupBy("cell").agg(F.sum("rows").alias("rows"))
        rows = sorted(found.collect(), key=lambda r: -r["cell"])  # 2 ** 16 at most
        if not rows:
            return 0.0
        if want is None:
            want = max(1, int(np.ceil(share * sum(r["rows"] for r in rows))))
        for r in rows:
            if r["rows"] >= want:
                cell = r["cell"]
                break
            want -= r["rows"]
        if high is not None:
            return float(np.uint32(high << 16 | cell).view(np.float32))
        high = cell


def _curve(work: _Pass):
    """Validation rows by cell of their margin and label: weights are not counted, as in the curve of the test rows."""
    def run(batches):
        counts, loss = np.zeros((2, SCORE_CELLS), np.int64), 0.0
        for batch in batches:
            if batch.num_rows:
                _, _, label, weight, valid, margin = work.rows(batch)
                cell = np.clip((margin[valid] + 16) * (SCORE_CELLS / 32), 0, SCORE_CELLS - 1).astype(np.int64)
                for y in (0, 1):
                    counts[y] += np.bincount(cell[label[valid] == y], minlength=SCORE_CELLS)
                sign = np.where(label[valid] == 1, -margin[valid], margin[valid])
                loss += float((weight[valid] * np.logaddexp(0, sign)).sum())
        label, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cell, -1), pa.int32()), pa.array(np.append(label, 0), pa.int32()),
             pa.array(np.append(counts[label, cell], 0), pa.int64()), pa.array(np.append(np.zeros(len(cell)), loss))],
            names=["cell", "label", "rows", "loss"])

    return run


def validation_score(state: DataFrame, work: _Pass, metric: str) -> float:
    """Average precision of the validation rows over cells of margins (higher is better), or minus their logistic loss."""
    found = state.where("valid").mapInArrow(_curve(work), "cell int, label int, rows long, loss double")
    rows = found.groupBy("cell", "label").agg(F.sum("rows").alias("rows"), F.sum("loss").alias("loss")).collect()  # 2 x SCORE_CELLS
    if metric == "logloss":
        return -sum(r.loss for r in rows)
    counts = np.zeros((2, SCORE_CELLS))
    for r in rows:
        if r.cell >= 0:
            counts[r.label, r.cell] += r["rows"]
    tp, fp = np.cumsum(counts[1][::-1]), np.cumsum(counts[0][::-1])
    if not len(tp) or tp[-1] == 0:
        return 0.0
    return float((counts[1][::-1] / tp[-1] * tp / np.maximum(tp + fp, 1)).sum())


def _carried(work: _Pass):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                margin = work.rows(batch)[-1]
                names = [c for c in batch.schema.names if c != "margin"]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(margin)], names=[*names, "margin"])

    return run


class Boosting:
    """Training that can go on: `run(rounds)` adds rounds until there are so many, patience runs out or no tree splits."""

    def __init__(self, train: DataFrame, columns, params=NewtonParams(), label=LABEL, ts=TS, seed=settings.SEED,
                 early_stopping=True, patience=settings.EARLY_STOPPING_ROUNDS, metric="aucpr", key="tx_id", valid=None):
        """`valid` tells the validation rows; without it they are those of the last time fold, or none without early stopping."""
        spark = train.sparkSession
        package_on_workers(spark)
        self.params, self.seed, self.metric, self.patience = params, seed, metric, patience
        columns = list(columns)
        if valid is None and early_stopping:
            start = fold_start_literals(train, settings.CV_FOLDS, ts)[-1]
            both = train.where(F.col(ts) < start).select(label).distinct().count() == 2
            valid = F.col(ts) >= start if both and not train.where(F.col(ts) >= start).isEmpty() else None
        self.early_stopping = early_stopping and valid is not None
        valid = F.lit(False) if valid is None else F.coalesce(valid, F.lit(False))
        weight = float(class_weights(train.where(~valid), label).first()["scale_pos_weight"] or 1.0)
        edges = quantile_edges(train.where(~valid), columns, params.bins, params.exact_edges)
        if params.bins > 256:
            raise ValueError("bins beyond a byte")
        rows = train.select(
            draw_key(key, seed).alias("key"), F.col(label).cast("int").alias("label"),
            F.when(F.col(label) == 1, weight).otherwise(1.0).alias("weight"), valid.alias("valid"),
            F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("_numbers"))
        self.state = stage(rows.mapInArrow(_binned(edges), STATE), "boosting")
        self.model = BoostedTrees(columns, edges, [], params.learning_rate)
        self.written = 0  # trees whose margins the state holds
        self.done = False

    def _work(self, threshold=0.0) -> _Pass:
        model = self.model
        return _Pass(len(model.columns), model.trees[self.written:], model.learning_rate, len(model.trees), self.params, threshold)

    def features(self, turn: int) -> list:
        """The columns of one tree, by a draw for each column."""
        many = len(self.model.columns)
        take = max(1, int(round(self.params.colsample * many)))
        order = np.argsort(draws(np.arange(1, many + 1) * 0x9E3779B97F4A7C1 % (1 << KEY_BITS), turn + self.seed), kind="stable")
        return sorted(order[:take].tolist())

    def run(self, rounds: int | None = None) -> BoostedTrees:
        model, params = self.model, self.params
        rounds = params.rounds if rounds is None else rounds
        while len(model.trees) < rounds and not self.done:
            threshold = top_threshold(self.state, self._work(), params.top_share) if params.top_share is not None else 0.0
            tree = self._tree(self._work(threshold), self.features(len(model.trees)))
            if len(tree.feature) == 1:
                self.done = True
                break
            model.trees.append(tree)
            model.fitted_rounds += 1
            if self.early_stopping:
                score = validation_score(self.state, self._work(), self.metric)
                model.history.append((len(model.trees), score))
                best = max(model.history, key=lambda x: (x[1], -x[0]))[0]
                model.best_round = best
                self.done = len(model.trees) - best >= self.patience
            if len(model.trees) - self.written >= WRITE_EVERY:
                self.state = stage(self.state.mapInArrow(_carried(self._work()), STATE), "boosting")
                self.written = len(model.trees)
        return self.best()

    def best(self) -> BoostedTrees:
        """The trees up to the best round."""
        m = self.model
        kept = m.trees if m.best_round is None else m.trees[:m.best_round]
        return BoostedTrees(m.columns, m.edges, kept, m.learning_rate, list(m.history), m.fitted_rounds, m.best_round)

    def _splits(self, work, tree, nodes, features) -> dict:
        """{node: its best split, as best_splits gives it}."""
        slots = {n: i for i, n in enumerate(nodes)}
        sums = self.state.where("not valid").mapInArrow(_histograms(work, tree, slots, features), SUMS)
        p = self.params
        rows = best_splits(sums, p.reg_lambda, p.min_child_weight, p.gamma).collect()  # one for each open node
        return {nodes[r.slot]: r for r in rows}

    def _apply(self, tree, node, best) -> int:
        lam = self.params.reg_lambda
        return tree.split(node, -best.feature, -best.bin, best.gain, [
            (_value(best[f"{s}_g"], best[f"{s}_h"], lam), best[f"{s}_h"], best[f"{s}_n"]) for s in ("left", "right")])

    def _root(self, tree, row):
        tree.value[0] = _value(row.total_g, row.total_h, self.params.reg_lambda)
        tree.hessian[0], tree.rows[0] = row.total_h, row.total_n

    def _tree(self, work, features) -> Tree:
        return self._by_leaf(work, features) if self.params.leaves else self._by_level(work, features)

    def _by_level(self, work, features) -> Tree:
        tree, nodes = Tree(), [0]
        for level in range(self.params.depth):
            found = self._splits(work, tree, nodes, features)
            if level == 0 and 0 in found:
                self._root(tree, found[0])
            nodes = [c for n in nodes if n in found and found[n].best is not None
                     for left in [self._apply(tree, n, found[n].best)] for c in (left, left + 1)]
            if not nodes:
                break
        return tree

    def _by_leaf(self, work, features) -> Tree:
        """Always splits the leaf with the largest gain (of equal ones the oldest). Children of the next few leaves are split on a trial
        tree, so that one pass sums up several; the tree itself takes them strictly in order of gain."""
        tree, open_, known = Tree(), {}, {}  # open_: leaf -> its best split; known: path -> its best split
        paths = {0: ()}
        found = self._splits(work, tree, [0], features)
        if 0 in found:
            self._root(tree, found[0])
            known[()] = found[0].best
        if known.get(()) is not None:
            open_[0] = known[()]
        leaves = 1
        while open_ and leaves < self.params.leaves:
            order = sorted(open_, key=lambda n: (-open_[n].gain, n))
            best = order[0]
            if paths[best] + (0,) not in known and tree.depth[best] + 1 < self.params.depth:
                trial = Tree(**{k: list(v) for k, v in vars(tree).items()})
                ask = {}
                for n in order[:AHEAD]:
                    if paths[n] + (0,) not in known and tree.depth[n] + 1 < self.params.depth:
                        left = self._apply(trial, n, open_[n])
                        ask |= {left: paths[n] + (0,), left + 1: paths[n] + (1,)}
                found = self._splits(work, trial, list(ask), features)
                known |= {path: found[n].best if n in found else None for n, path in ask.items()}
            left = self._apply(tree, best, open_.pop(best))
            leaves += 1
            for side in (0, 1):
                paths[left + side] = paths[best] + (side,)
                split = known.get(paths[left + side])
                if split is not None:
                    open_[left + side] = split
        return tree


def fit_newton_trees(train: DataFrame, columns, params=NewtonParams(), **options) -> BoostedTrees:
    """Second-order boosted trees with class weight (see NewtonParams).

    A split's gain is G_l^2 / (H_l + lambda) + G_r^2 / (H_r + lambda) - G^2 / (H + lambda) and must exceed `gamma`; each child needs a
    hessian of `min_child_weight`; a leaf's value is -G / (H + lambda). Rows and columns are drawn for each tree. With early
    stopping the latest fifth of the rows (by time) only tells the score after each round; training ends when `patience` rounds
    bring nothing better, and the model has the rounds up to the best one. Trees with one class don't split.
    """
    return Boosting(train, columns, params, **options).run()


def feature_gain(nodes: DataFrame) -> DataFrame:
    """(feature, splits, gain, total_gain): mean and sum of the gains of a feature's splits, from a table of nodes."""
    return nodes.where("feature is not null").groupBy("feature").agg(
        F.count("*").alias("splits"), F.avg("gain").alias("gain"), F.sum("gain").alias("total_gain"))
