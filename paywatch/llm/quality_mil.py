"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of up to 64 words. Each passage is encoded (how its characters follow each other, how its words
repeat, then one learned layer); a gated attention weighs the passages; the weighted sum is scored. Only documents have
labels: the weights of the passages are learned from them. Training runs on the driver over all passages of a bounded
sample of labelled documents; scoring reads every whole text and needs the few thousand learned numbers only.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructType

from paywatch.llm.common import mix, slices, utf8
from paywatch.session import stage

WORDS = 64  # words of a passage, at most
SAMPLE = 3000  # labelled documents to fit on, at most
PASSAGES = 200_000  # of all of them together, at most: documents beyond that are left out whole
HIDDEN, GATE = 24, 12
THRESHOLD = 0.3  # fixed value of the contract
SLICE = 1 << 19  # bytes of texts at a time: working memory is about 50 times as much

# Classes of bytes: lower, upper, digit, blank, line end, full stop or comma, other signs, beyond ASCII.
CLASSES = np.full(256, 6, np.uint8)
CLASSES[ord("a"):ord("z") + 1] = 0
CLASSES[ord("A"):ord("Z") + 1] = 1
CLASSES[ord("0"):ord("9") + 1] = 2
CLASSES[[9, 11, 12, 32]] = 3
CLASSES[[10, 13]] = 4
CLASSES[[ord("."), ord(",")]] = 5
CLASSES[128:] = 7
N_CLASSES = 8
SHAPES = 4
FEATURES = N_CLASSES * N_CLASSES + SHAPES

_rng = np.random.default_rng(7)
LETTERS = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
LETTERS[ord("A"):ord("Z") + 1] = LETTERS[ord("a"):ord("z") + 1]


def passages(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage, and the row border of the documents in them. Every document has a passage: one
    without words has one with all features zero."""
    data, borders = utf8(texts)
    rows = len(borders) - 1
    kinds = CLASSES[data]
    blank = (kinds == 3) | (kinds == 4)
    first = np.zeros(len(data) + 1, bool)
    first[borders[:-1]] = True
    starts = np.flatnonzero(~blank & (np.concatenate([[True], blank[:-1]]) | first[:-1]) if len(data) else [])
    row = np.searchsorted(borders, starts, side="right") - 1
    per_row = np.bincount(row, minlength=rows)
    within = np.arange(len(starts)) - (np.cumsum(per_row) - per_row)[row]
    sizes = np.maximum(1, -(-per_row // words))
    until = np.cumsum(sizes)
    out = np.zeros((int(until[-1]) if rows else 0, FEATURES), np.float32)
    if len(starts):
        passage = (until - sizes)[row] + within * sizes[row] // per_row[row]  # of equal length, none a short rest
        count = np.bincount(passage, minlength=len(out)).astype(np.float32)
        # Neighbouring classes, counted where the second byte lies: behind the first word of a passage, up to the next one.
        of = np.repeat(passage, np.diff(np.append(starts, len(data))))
        pair = kinds[starts[0]:].astype(np.int64)
        pair[1:] += N_CLASSES * kinds[starts[0]:-1].astype(np.int64)
        inside = np.ones(len(pair), bool)
        inside[starts[within == 0] - starts[0]] = False  # nor over the border of two documents
        # White space at the head of a document is nothing of the one before.
        heads = borders[:-1][(np.diff(borders) > 0) & (borders[:-1] > starts[0])]
        heads = heads[blank[heads]]
        behind = np.append(starts, len(data))[np.searchsorted(starts, heads)]
        for a, b in zip((heads - starts[0]).tolist(), (behind - starts[0]).tolist()):
            inside[a:b] = False
        grams = np.bincount(of[inside] * N_CLASSES**2 + pair[inside], minlength=len(out) * N_CLASSES**2)
        out[:, :N_CLASSES**2] = grams.reshape(len(out), -1) / np.maximum(count * 6, 1)[:, None]
        # Words by the sum of their letters' numbers: repeated ones, different ones, length.
        codes = np.where(blank, np.uint64(0), LETTERS[data])
        codes = mix(np.add.reduceat(codes, starts))
        again = np.zeros(len(starts), np.float32)
        again[1:] = (codes[1:] == codes[:-1]) & (passage[1:] == passage[:-1])
        base = N_CLASSES**2
        out[:, base] = np.bincount(passage, again, len(out)) / np.maximum(count, 1)
        order = np.lexsort((codes, passage))
        c, p = codes[order], passage[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (p[1:] != p[:-1])
        out[:, base + 1] = np.bincount(p[new], minlength=len(out)) / np.maximum(count, 1)
        letters = np.add.reduceat((~blank).astype(np.int32), starts)
        out[:, base + 2] = np.bincount(passage, letters, len(out)) / np.maximum(count, 1) / 8
        out[:, base + 3] = count / words
    return out, np.concatenate([[0], until])


@dataclass
class Model:
    """Scale of the features, encoder, gated attention and output."""

    parts: dict

    @classmethod
    def start(cls, features: np.ndarray, prior: float, hidden: int = HIDDEN, gate: int = GATE) -> "Model":
        rng = np.random.default_rng(11)
        draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        spread = features.std(0)
        p = {"mean": features.mean(0), "scale": 1 / np.maximum(spread, 0.02), "encode": draw(features.shape[1], hidden),
             "shift": np.zeros(hidden, np.float32), "tanh": draw(hidden, gate), "gate": draw(hidden, gate),
             "weigh": draw(gate, 1)[:, 0], "out": draw(hidden, 1)[:, 0],
             "bias": np.full(1, np.log(prior / (1 - prior)), np.float32)}
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def forward(self, x: np.ndarray, borders: np.ndarray) -> dict:
        p, starts = self.parts, borders[:-1]
        sizes = np.diff(borders)
        z = np.clip((x - p["mean"]) * p["scale"], -6, 6)
        h = np.tanh(z @ p["encode"] + p["shift"])
        v, u = np.tanh(h @ p["tanh"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        s = (v * u) @ p["weigh"]
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        bag = np.add.reduceat(a[:, None] * h, starts)
        score = 1 / (1 + np.exp(-(bag @ p["out"] + p["bias"][0]).astype(np.float64)))
        return {"z": z, "h": h, "v": v, "u": u, "a": a, "bag": bag, "score": score}

    def gradients(self, x: np.ndarray, borders: np.ndarray, labels: np.ndarray) -> dict:
        p, f = self.parts, self.forward(x, borders)
        starts, sizes = borders[:-1], np.diff(borders)
        d = ((f["score"] - labels) / len(labels)).astype(np.float32)
        d_bag = np.repeat(d[:, None] * p["out"], sizes, axis=0)
        d_a = (d_bag * f["h"]).sum(1)
        d_s = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, starts), sizes))
        d_vu = d_s[:, None] * p["weigh"]
        d_v, d_u = d_vu * f["u"] * (1 - f["v"]**2), d_vu * f["v"] * f["u"] * (1 - f["u"])
        d_h = (f["a"][:, None] * d_bag + d_v @ p["tanh"].T + d_u @ p["gate"].T) * (1 - f["h"]**2)
        return {"encode": f["z"].T @ d_h, "shift": d_h.sum(0), "tanh": f["h"].T @ d_v, "gate": f["h"].T @ d_u,
                "weigh": (f["v"] * f["u"]).T @ d_s, "out": f["bag"].T @ d, "bias": d.sum(keepdims=True)}


def fit(x: np.ndarray, borders: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.01,
        decay: float = 3e-3) -> Model:
    """Adam on all bags at once, with weight decay on encoder and output."""
    prior = float(np.clip(labels.mean(), 0.01, 0.99))
    model = Model.start(x, prior)
    first = {k: 0.0 for k in ("encode", "shift", "tanh", "gate", "weigh", "out", "bias")}
    second = dict(first)
    for t in range(1, rounds + 1):
        for k, g in model.gradients(x, borders, labels).items():
            g = g + decay * model.parts[k] * (k in ("encode", "out"))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            step = rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
            model.parts[k] = (model.parts[k] - step).astype(np.float32)
    return model


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _bags(words):
    def run(batches):
        for part in slices(batches, "text", SLICE):
            x, borders = passages(part.column("text"), words)
            bags = [x[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(np.diff(borders), pa.int64()), pa.array(bags, pa.binary())],
                names=["doc_id", "label", "size", "bag"])

    return run


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", sample: int = SAMPLE, most: int = PASSAGES,
          words: int = WORDS) -> Model | None:
    """Fits on labelled documents outside the held-out fold, in the order of a hash of their id: on at most `sample` of them and as
    many as have `most` passages together (one at least). Each document comes with all its passages. Ids with several
    labels get their mean. None if there is no labelled document."""
    known = labels.select(F.col("doc_id").cast("long"), F.col(column).cast("double").alias("label")).dropna()
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
    bags = rows.mapInArrow(_bags(words), "doc_id long, label double, size long, bag binary")
    # One bag for each id, also where rows repeat an id.
    bags = stage(bags.groupBy("doc_id").agg(F.min(F.struct("label", "bag", "size")).alias("one")), "bags")
    sizes = sorted(bags.select(F.xxhash64("doc_id").alias("at"), "doc_id", "one.size").collect())  # `sample` rows
    if not sizes:
        return None
    within = np.cumsum([r.size for r in sizes]) <= most
    within[0] = True
    last = sizes[int(np.flatnonzero(within)[-1])]
    bags = bags.where(F.struct(F.xxhash64("doc_id").alias("at"), "doc_id") <= F.struct(
        F.lit(last["at"]).alias("at"), F.lit(last.doc_id).cast("long").alias("doc_id"))).select("one.label", "one.bag").collect()
    bags = sorted((r.label, bytes(r.bag)) for r in bags)
    x = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, b in bags]
    borders = np.concatenate([[0], np.cumsum([len(b) for b in x])])
    return fit(np.concatenate(x), borders, np.array([label for label, _ in bags]))


def _score(model, words, names, name):
    """Returns the columns `names` and the score as `name`."""
    def run(batches):
        for part in slices(batches, "text", SLICE):
            x, borders = passages(part.column("text"), words)
            score = np.full(len(part), 0.5) if model is None else model.forward(x, borders)["score"]
            columns = [part.column(part.schema.names.index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.round(score, 6))], names=[*names, name])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Inputs of a score are the text's passages only. Null and empty texts are one passage without words. Without any
    label every score is 0.5. A null id is hashed as an empty text; repeated rows each get their row; other columns
    are ignored; an empty table gives none. All passages of a text are scored, however long it is.
    """
    model = train(docs, labels, sample=sample, words=words)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    scored = rows.mapInArrow(_score(model, words, ["doc_id"], "score"), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, words: int = WORDS) -> DataFrame:
    """The rows of `docs`, with their columns, that `score_quality` predicts as 1."""
    model = train(docs, labels, sample=sample, words=words)
    name = "_score"
    while name in docs.columns:
        name += "_"
    scored = docs.mapInArrow(_score(model, words, docs.columns, name), StructType([*docs.schema.fields]).add(name, DoubleType()))
    return scored.where(F.col(name) >= THRESHOLD).drop(name)
