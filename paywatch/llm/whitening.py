"""Embedding whitening by incremental eigendecomposition.

A spectrum is a number of vectors, their mean, and eigenvalues and eigenvectors of their scatter matrix. Each vector changes it
by one centred rank-one update: the new eigenvalues are the roots of a secular equation, components that the update doesn't touch
and equal eigenvalues are deflated, and the eigenvectors follow from the roots. Every partition updates a few spectra side by side
(one numpy call serves all of them). Two spectra are combined by successive rank-one updates, too: one for each eigenpair of the
second and one for the distance of the means; partitions are combined in groups of FAN, level by level. A last distributed pass projects
the covariance on the vectors found (Rayleigh-Ritz), which takes out what the updates have gathered in rounding errors.

No task and not the driver hold more than one spectrum of dims x dims numbers for each stream.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import slices
from paywatch.session import stage

SCALE, SHIFT = 64, 1_000_000  # fixed values of the contract
COMPONENTS = 16
FAN = 16
BLOCK = 1 << 17  # numbers that the streams of a partition work on at once, about
EPS = np.finfo(np.float64).eps
FLOOR = 1e-12  # of the trace: smaller eigenvalues count as zero
ROUNDS = 60
NEAR = 1e-11  # of the terms of a secular equation: a smaller sum is zero; the last projection takes the rest out
LIMIT = 1 << 62


class Spectra:
    """Several spectra of `dims` dimensions side by side: counts, means, eigenvalues (ascending) and eigenvectors (columns)."""

    def __init__(self, count, mean, values, vectors):
        self.count, self.mean, self.values, self.vectors = count, mean, values, vectors

    @classmethod
    def empty(cls, streams: int, dims: int) -> "Spectra":
        return cls(np.zeros(streams), np.zeros((streams, dims)), np.zeros((streams, dims)),
                   np.broadcast_to(np.eye(dims), (streams, dims, dims)).copy())

    def part(self, which: slice) -> "Spectra":
        """A view: updates of the part are updates of the whole."""
        return Spectra(self.count[which], self.mean[which], self.values[which], self.vectors[which])

    def add(self, rows: np.ndarray):
        """One row to each spectrum: a rank-one update centred on the mean so far."""
        away = rows - self.mean
        weight = self.count / (self.count + 1)
        self.count += 1
        self.mean += away / self.count[:, None]
        rank_one(self.values, self.vectors, away, weight)

    def combine(self, other: "Spectra"):
        """Each spectrum with its partner in `other`, eigenpair by eigenpair."""
        both = self.count + other.count
        for j in range(other.values.shape[1]):
            rank_one(self.values, self.vectors, other.vectors[:, :, j], np.maximum(other.values[:, j], 0))
        away = other.mean - self.mean
        rank_one(self.values, self.vectors, away, self.count * other.count / np.maximum(both, 1))
        self.mean += away * (other.count / np.maximum(both, 1))[:, None]
        self.count += other.count

    def folded(self) -> "Spectra":
        """All of them combined into one."""
        out = self
        while len(out.count) > 1:
            half = (len(out.count) + 1) // 2
            first, rest = out.part(slice(0, half)), out.part(slice(half, None))
            first.part(slice(0, len(rest.count))).combine(rest)
            out = first
        return out

    def to_bytes(self) -> bytes:
        return b"".join(np.ascontiguousarray(x, "<f8").tobytes() for x in (self.count, self.mean, self.values, self.vectors))

    @classmethod
    def from_bytes(cls, data: list, dims: int) -> "Spectra":
        flat = np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1).copy()
        return cls(flat[:, 0].copy(), flat[:, 1:dims + 1].copy(), flat[:, dims + 1:2 * dims + 1].copy(),
                   flat[:, 2 * dims + 1:].reshape(-1, dims, dims).copy())


def rank_one(values: np.ndarray, vectors: np.ndarray, direction: np.ndarray, weight: np.ndarray):
    """In place, the eigenpairs of Q diag(values) Q' + weight * direction direction' for each spectrum."""
    z = np.matmul(direction[:, None, :], vectors)[:, 0] * np.sqrt(weight)[:, None]
    size = np.maximum(np.abs(values).max(1), (z * z).sum(1))
    _rotate_equal(values, vectors, z, 8 * EPS * size)
    # Deflation: what the update doesn't touch keeps its pair.
    live = z * z > (EPS * EPS * size)[:, None]
    live &= np.abs(z) * np.sqrt((z * z).sum(1))[:, None] > (EPS * size)[:, None]
    if not live.any():
        return
    z = np.where(live, z, 0.0)
    roots, away = secular_roots(values, z, live)  # away: by root, then by value
    # Gu and Eisenstat: the z for which the computed roots are exact gives orthogonal vectors.
    whole, diagonal = live.all(), np.eye(values.shape[1], dtype=bool)
    ratio = np.subtract(values[:, None, :], values[:, :, None], out=_space(away.shape, 1))
    ratio[:, diagonal] = -1.0
    if not whole:
        both = live[:, :, None] & live[:, None, :]
        ratio[~both], away[~both] = 1.0, 1.0
    np.divide(away, ratio, out=ratio)  # (value - root) / (value - other value)
    exact = np.sqrt(np.abs(np.multiply.reduce(ratio, axis=1))) * np.where(z < 0, -1.0, 1.0)
    turn = np.divide(exact[:, None, :], away, out=ratio)
    if not whole:
        turn[~both] = 0.0
    length = np.sqrt(np.maximum(np.einsum("bji,bji->bj", turn, turn), np.finfo(np.float64).tiny))
    turn /= length[:, :, None]
    if not whole:
        turn = np.where(live[:, :, None], turn, diagonal)
        order = np.argsort(roots, axis=1, kind="stable")
        turn = np.take_along_axis(turn, order[:, :, None], axis=1)
        roots = np.take_along_axis(roots, order, axis=1)
    values[:] = roots
    vectors[:] = np.matmul(vectors, np.swapaxes(turn, 1, 2), out=_space(vectors.shape, 2))


_spaces: dict = {}


def _space(shape, number: int) -> np.ndarray:
    """A work array that is used again and again: fresh memory costs more than the arithmetic."""
    size = int(np.prod(shape))
    if len(_spaces.get(number, ())) < size:
        _spaces[number] = np.empty(size)
    return _spaces[number][:size].reshape(shape)


def _rotate_equal(values, vectors, z, least):
    """Turns vectors of equal eigenvalues so that the update touches one of them only (the last): all vectors of eigenvalue zero by
    one reflection, others pair by pair."""
    empty = (values <= least[:, None]) & (z != 0)
    if (empty.sum(1) > 1).any():
        last = np.maximum(np.where(empty, np.arange(z.shape[1]), -1).max(1), 0)
        axis = (np.arange(z.shape[1]) == last[:, None]) * 1.0
        part = np.where(empty, z, 0.0)
        length = np.sqrt((part * part).sum(1))[:, None]
        end = np.where((part * axis).sum(1)[:, None] > 0, -length, length)  # of the other sign: nothing cancels
        mirror = part - end * axis
        square = (mirror * mirror).sum(1)
        factor = np.where(square > 0, 2 / np.where(square > 0, square, 1), 0.0)
        vectors -= np.matmul(vectors, mirror[:, :, None]) * (factor[:, None] * mirror)[:, None, :]
        z[:] = np.where(empty, end * axis, z)
    near = values[:, 1:] - values[:, :-1] <= least[:, None]
    if not (near & (z[:, :-1] != 0)).any():
        return
    for i in range(z.shape[1] - 1):
        a, b = z[:, i].copy(), z[:, i + 1].copy()
        on = near[:, i] & (a != 0)
        if not on.any():
            continue
        r = np.hypot(a, b)
        c, s = np.where(on, b / np.where(on, r, 1), 1.0), np.where(on, a / np.where(on, r, 1), 0.0)
        left, right = vectors[:, :, i], vectors[:, :, i + 1]
        left, right = c[:, None] * left - s[:, None] * right, s[:, None] * left + c[:, None] * right
        vectors[:, :, i], vectors[:, :, i + 1] = left, right
        z[:, i], z[:, i + 1] = np.where(on, 0.0, a), np.where(on, r, b)


def secular_roots(values: np.ndarray, z: np.ndarray, live: np.ndarray):
    """Roots of 1 + sum(z^2 / (values - root)) = 0, one above each live value, and values - root for all pairs
    (root, value), exact for the neighbours of a root. Each root is sought as a distance from the nearer pole: by fits of one
    pole on either side, by halving where a fit leaves the bracket."""
    dims = values.shape[1]
    tiny = np.finfo(np.float64).tiny
    squares = z * z
    above = np.where(live, values, np.inf)
    following = np.full_like(values, np.inf)
    following[:, :-1] = np.minimum.accumulate(above[:, :0:-1], axis=1)[:, ::-1]
    last = ~np.isfinite(following)
    reach = squares.sum(1)[:, None]
    gap = np.where(live, np.where(last, reach, following - values), 1.0)

    # The sign in the middle tells which pole is nearer; the rest of the sum taken as constant gives a first guess.
    half = gap / 2
    middle = np.subtract(values[:, None, :], (values + half)[:, :, None], out=_space((*values.shape, dims), 1))
    lone = live.all()  # else a value that the update leaves alone may lie anywhere
    if not lone:
        np.copyto(middle, tiny, where=middle == 0)
    sign = 1 + np.matmul(np.divide(1.0, middle, out=middle), squares[:, :, None])[:, :, 0]
    left = (sign >= 0) | last
    origin = np.where(left, values, np.where(last, values, following))
    low, high = np.where(left, 0.0, -half), np.where(left, np.where(last, gap, half), 0.0)
    above = np.minimum.accumulate(np.where(live, np.arange(dims), dims)[:, ::-1], axis=1)[:, ::-1]
    above = np.take_along_axis(np.concatenate([squares, np.zeros((len(z), 2))], 1), np.concatenate(
        [above[:, 1:], np.full((len(z), 1), dims)], 1), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = sign + (squares - np.where(last, 0.0, above)) / half
        both = rest * gap + squares + above
        root = np.sqrt(np.maximum(both * both - 4 * rest * squares * gap, 0))
        from_left = np.where(both > 0, 2 * squares * gap / (both + root), (both - root) / (2 * rest))
        both = rest * gap - squares - above
        root = np.sqrt(np.maximum(both * both + 4 * rest * above * gap, 0))
        from_right = -np.where(both <= 0, 2 * above * gap / (root - both), (both + root) / (2 * rest))
        steps = np.where(last, np.where(rest > 0, squares / rest, np.nan), np.where(left, from_left, from_right))
    steps = np.where((steps > low) & (steps < high), steps, (low + high) / 2)

    far = np.subtract(values[:, None, :], origin[:, :, None], out=_space(middle.shape, 3))
    side = np.tril(np.ones((dims, dims)))

    def sums(here, of_all, mask, step):
        """Of z^2 / (value - step) and z^2 / (value - step)^2: over all values and over those below the root."""
        inverse = np.subtract(here, step[..., None], out=_space(here.shape, 1))
        if not lone:
            np.copyto(inverse, tiny, where=inverse == 0)
        np.divide(1.0, inverse, out=inverse)
        low = _space(here.shape, 2)
        out = []
        for power in (1, 2):
            out += [np.matmul(inverse, of_all)[..., 0], np.matmul(np.multiply(inverse, mask, out=low), of_all)[..., 0]]
            np.multiply(inverse, inverse, out=inverse)
        return out

    step, below, alone = steps, np.where(left, 0.0, -gap), last
    here, of_all, mask, at, todo = far, squares[:, :, None], side, None, live
    for _ in range(ROUNDS):
        total, psi, slope, slope_low = sums(here, of_all, mask, step)
        f = 1 + total
        low, high = np.where(f < 0, step, low), np.where(f < 0, high, step)
        a, b = below - step, np.where(alone, 1.0, below + gap - step)
        # One pole on either side of the root; the last root has none above.
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            c = f - a * slope_low - b * (slope - slope_low)
            p, q = (a + b) * f - a * b * slope, a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            move = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            c = f - a * slope_low
            new = step + np.where(alone, np.where(c > 0, a + a * a * slope_low / c, np.nan), move)
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        todo = todo & (np.abs(f) > NEAR * (1 + np.abs(psi) + np.abs(total - psi))) & (np.abs(new - step) > 2 * EPS * np.abs(new))
        step = np.where(todo, new, step)
        if at is not None:
            steps.ravel()[at] = step
        else:
            steps = step
        if not todo.any():
            break
        if 3 * np.count_nonzero(todo) < todo.size:  # from here a row for each root that is still sought
            if at is None:
                at = np.flatnonzero(todo)
                here, of_all, mask = far.reshape(-1, 1, dims)[at], squares[at // dims][:, :, None], side[at % dims][:, None, :]
                step, low, high, gap, alone, below = (x.ravel()[at][:, None] for x in (step, low, high, gap, alone, below))
                at = at[:, None]
            else:
                keep = todo[:, 0]
                at, here, of_all, mask, step, low, high, gap, alone, below = (
                    x[keep] for x in (at, here, of_all, mask, step, low, high, gap, alone, below))
            todo = np.ones(step.shape, bool)
    away = np.subtract(far, steps[:, :, None], out=far)
    if not lone:
        np.copyto(away, -tiny, where=away == 0)
    return np.where(live, origin + steps, values), away


# Rows --------------------------------------------------------------------------------------------------------------

def whole(values: np.ndarray) -> np.ndarray:
    """floor(64 * c) + 1000000, kept within 64 bits."""
    return np.clip(np.floor(values * SCALE), -float(LIMIT), float(LIMIT)).astype(np.int64) + SHIFT


def _usable(column: pa.Array, dims: int | None):
    """Rows whose vector has no null or non-finite entry (and `dims` entries), and their entries one after another."""
    sizes = np.diff(column.offsets.to_numpy())
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.values.cast(pa.float64())
    flat = flat.to_numpy(zero_copy_only=False) if flat.null_count == 0 else np.asarray(
        [np.nan if v is None else v for v in flat.to_pylist()])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    starts = column.offsets.to_numpy()
    valid &= (bad[starts[1:]] == bad[starts[:-1]]) & (sizes > 0)
    if dims is not None:
        valid &= sizes == dims
    return np.flatnonzero(valid), starts, flat


def _lists(column) -> pa.ListArray:
    return column.cast(pa.list_(pa.float64()))


def _lengths(batches):
    for batch in batches:
        column = _lists(batch.column("embedding"))
        good, starts, _ = _usable(column, None)
        length, rows = np.unique(np.diff(starts)[good], return_counts=True)
        if len(length):
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int32()), pa.array(rows, pa.int64())], names=["length", "rows"])


def _vectors(column, dims: int):
    """Numbers of the usable rows and their x vectors."""
    column = _lists(column)
    good, starts, flat = _usable(column, dims)
    at = starts[:-1][good][:, None] + np.arange(dims)
    return good, whole(flat[at])


def _packed(dims: int):
    def run(batches):
        for part in slices(batches, "embedding", 1 << 20):
            _, x = _vectors(part.column("embedding"), dims)
            small = (np.abs(x) < 1 << 31).all(1)  # decided for each vector: equal vectors are equal bytes
            rows = [x[i].astype("<i4").tobytes() if s else x[i].astype("<i8").tobytes() for i, s in enumerate(small.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])

    return run


def _read(batches, dims: int):
    """x vectors of batches of the fit list."""
    for batch in batches:
        rows = batch.column("x").to_pylist()
        out = np.zeros((len(rows), dims), np.int64)
        wide = [i for i, r in enumerate(rows) if len(r) == 8 * dims]
        if len(wide) < len(rows):
            narrow = [i for i, r in enumerate(rows) if len(r) == 4 * dims]
            out[narrow] = np.frombuffer(b"".join(rows[i] for i in narrow), "<i4").reshape(-1, dims)
        if wide:
            out[wide] = np.frombuffer(b"".join(rows[i] for i in wide), "<i8").reshape(-1, dims)
        if len(rows):
            yield out


def _sums(dims: int):
    def run(batches):
        total, count = [0] * dims, 0
        for x in _read(batches, dims):
            half = x >> 31  # two halves, so that no sum leaves 64 bits
            high, low = half.sum(0).tolist(), (x - (half << 31)).sum(0).tolist()
            total = [t + (h << 31) + r for t, h, r in zip(total, high, low)]
            count += len(x)
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
                 pa.array([count] * dims, pa.int64())], names=["dim", "sum", "n"])

    return run


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n; the numerator n x - S is a whole number, so only its division rounds."""
    return scaled_distance(x, n, sums).astype(np.float64) / n


def scaled_distance(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, as Python integers where 64 bits don't hold it."""
    most = int(max(x.max(initial=0), -x.min(initial=0)))
    if n * most < LIMIT and max(map(abs, sums), default=0) < LIMIT:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviation(distance: np.ndarray) -> list:
    """Sum of squares of each row, exact; None where it doesn't fit into 64 bits."""
    most = int(max(abs(distance.max(initial=0)), abs(distance.min(initial=0))))
    if most * most * distance.shape[1] < 1 << 63:
        return (distance.astype(np.int64)**2).sum(1).tolist()
    return [s if s < 1 << 63 else None for s in (sum(int(v)**2 for v in row) for row in distance)]


def _updated(dims: int, n: int, sums: list[int]):
    """One spectrum for each partition of the fit list."""
    def run(batches):
        spectra = None
        for x in _read(batches, dims):
            rows = centred(x, n, sums)
            if spectra is None:  # combining streams costs dims + 1 updates each: few streams for few rows
                most = max(1, min(BLOCK // dims**2, len(rows) // (6 * dims)))
                spectra = Spectra.empty(most, dims)
            streams = len(spectra.count)
            for i in range(0, len(rows), streams):
                part = rows[i:i + streams]
                spectra.part(slice(0, len(part))).add(part)
        if spectra is not None:
            yield pa.RecordBatch.from_arrays([pa.array([spectra.folded().to_bytes()], pa.binary())], names=["state"])

    return run


def _tree(states: DataFrame, combine, name: str) -> bytes | None:
    """One state from those of all partitions: groups of FAN are combined by tasks, level by level."""
    one = lambda frame: frame.iloc[:1].assign(state=[combine(frame["state"].tolist())])
    states = stage(states.withColumn("at", F.spark_partition_id()), name)
    while True:
        rows = states.count()
        if rows <= 1:
            break
        states = stage(states.withColumn("at", F.expr(f"at div {FAN}")).groupBy("at").applyInPandas(
            one, "state binary, at int"), name)
    row = states.first()
    return None if row is None else bytes(row.state)


def _added(states: list) -> bytes:
    return np.sum([np.frombuffer(s, "<f8") for s in states], axis=0).tobytes()


def _products(dims: int, n: int, sums: list[int], vectors: np.ndarray):
    """Sum over the fit list of y y', y being a centred vector seen along `vectors`."""
    def run(batches):
        total = 0.0
        for x in _read(batches, dims):
            y = centred(x, n, sums) @ vectors
            total = total + y.T @ y
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary())], names=["state"])

    return run


def _whitened(dims: int, n: int, sums: list[int], directions: np.ndarray, explained: np.ndarray, error: float):
    """Directions are divided by the square roots of their eigenvalues."""
    many = directions.shape[1]

    def run(batches):
        for part in slices(batches, "embedding", 1 << 18):
            good, x = _vectors(part.column("embedding"), dims)
            if not len(good):
                continue
            distance = scaled_distance(x, n, sums)
            y = (distance.astype(np.float64) / n) @ directions
            row = np.repeat(np.arange(len(good)), many)
            total = len(row)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(good[row])), pa.array(np.tile(np.arange(1, many + 1), len(good)), pa.int32()),
                 pa.array(np.full(total, n), pa.int64()), pa.array(deviation(distance), pa.int64()).take(pa.array(row)),
                 pa.array(y.ravel()), pa.array(np.tile(explained, len(good))), pa.array(np.full(total, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def fit(rows: DataFrame, components: int):
    """(dims, n, S, directions, explained, largest error of the whitened covariance) of the distinct x vectors, or None."""
    lengths = rows.select("embedding").mapInArrow(_lengths, "length int, rows long")
    commonest = lengths.groupBy("length").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("length")).first()
    if commonest is None:
        return None
    dims = commonest["length"]
    fitted = stage(rows.select("embedding").mapInArrow(_packed(dims), "x binary").distinct(), "fit-list")
    sums = fitted.mapInArrow(_sums(dims), "dim int, sum decimal(38,0), n long").groupBy("dim").agg(
        F.sum("sum").cast("decimal(38,0)").alias("sum"), F.sum("n").alias("n")).orderBy("dim").collect()  # a row for each dimension
    n, sums = sums[0]["n"], [int(r["sum"]) for r in sums]

    def of(function):
        return fitted.mapInArrow(function, "state binary")

    state = _tree(of(_updated(dims, n, sums)), lambda s: Spectra.from_bytes(s, dims).folded().to_bytes(), "spectra")
    vectors = Spectra.from_bytes([state], dims).vectors[0]
    square = lambda data: np.frombuffer(data, "<f8").reshape(int(np.sqrt(len(data) // 8)), -1)
    projected = square(_tree(of(_products(dims, n, sums, vectors)), _added, "projected")) / n
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    values, vectors = values[::-1], (vectors @ turn)[:, ::-1]
    vectors, _ = np.linalg.qr(vectors)
    trace = float(np.trace(projected))
    kept = [k for k in range(min(components, dims)) if values[k] > FLOOR * trace]
    if not kept:
        return None
    directions = vectors[:, kept] / np.sqrt(values[kept])
    seen = square(_tree(of(_products(dims, n, sums, directions)), _added, "whitened")) / n
    return dims, n, sums, directions, values[kept] / trace, float(np.abs(seen - np.eye(len(kept))).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty or hold null or non-finite entries are left out, and so are those whose length isn't the commonest
    one (the longer of equally common ones). Entries are kept within 62 bits. The fit list holds each x vector once; rows that repeat
    and rows with a null id each get their rows. Components whose eigenvalue is zero (less than 1e-12 of the trace) are left out: a
    table with one distinct vector, and an empty table, give none. Equal eigenvalues leave their vectors undefined up to a rotation.
    `deviation` is null where it doesn't fit into a long. Other columns are ignored.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    found = fit(rows, components)
    if found is None:
        return rows.sparkSession.createDataFrame([], OUT)
    return rows.mapInArrow(_whitened(*found), OUT)
