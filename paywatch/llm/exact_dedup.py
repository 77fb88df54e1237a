"""Exact duplicates by content-defined chunk recipes.

A text is cut where a hash of eight neighbouring bytes ends in zeros, so equal stretches are cut alike wherever
they stand. A chunk is named by a 128-bit digest; every distinct chunk is moved once, and its bytes are compared
with those of all chunks of the same name (`verified`). Documents are then compared by their ordered lists of
verified names: long texts don't move again, and copies only bring their few names.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import join_hot, slices, utf8
from paywatch.session import stage

LEAST, MOST, BITS = 256, 8192, 10


def cuts(data: np.ndarray, borders: np.ndarray, least=LEAST, most=MOST, bits=BITS):
    """Yields the inner cut positions of each row, at least `least` and at most `most` bytes apart."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data),), np.dtype("<u8"), padded, strides=(1,))
    found = np.flatnonzero((words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits) == 0) + 8
    found = found.tolist()
    at = 0
    for start, end in zip(borders[:-1].tolist(), borders[1:].tolist()):
        out, last = [], start
        while at < len(found) and found[at] < start + 8:
            at += 1
        while end - last > most or at < len(found) and found[at] < end:
            cut = found[at] if at < len(found) and found[at] < end else end
            if cut - last > most:
                last += most
                out.append(last)
            elif cut - last < least:
                at += 1
            elif cut < end:
                out.append(cut)
                last = cut
                at += 1
            else:
                break
        yield [start, *out, end] if end > start else []


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes without white space, and the row borders in them."""
    data, borders = utf8(column)
    keep = ~((data == 32) | ((data >= 9) & (data <= 13)))
    counts = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], counts[borders]


def _chunks(text: pa.Array, seed: int):
    """For each row: its normalised bytes and its chunks as (name, bytes)."""
    data, borders = normalised(text)
    whole = data.tobytes()
    for ends in cuts(data, borders):
        parts = [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]
        yield parts, [xxhash.xxh3_128_digest(p, seed) for p in parts]


def _recipes(seed):
    def run(batches):
        for part in slices(batches, "text"):
            sums, recipes = [], []
            for parts, names in _chunks(part.column("text"), seed):
                sums.append(hashlib.sha256(b"".join(parts)).hexdigest())
                recipes.append(b"".join(names))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("chars"), pa.array(sums, pa.string()), pa.array(recipes, pa.binary())],
                names=["doc_id", "chars", "text_sha256", "recipe"])

    return run


def _contents(seed):
    def run(batches):
        for part in slices(batches, "text"):
            seen = {}
            for parts, names in _chunks(part.column("text"), seed):
                seen.update(zip(zip(names, parts), parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.binary()), pa.array(list(seen.values()), pa.binary())],
                names=["name", "content"])

    return run


def verified(docs: DataFrame, seed: int) -> bool:
    """Whether no two different chunks have the same name: compares the bytes of all chunks."""
    pieces = docs.select("text").mapInArrow(_contents(seed), "name binary, content binary")
    return pieces.distinct().groupBy("name").count().where("count > 1").isEmpty()


def recipes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, chars, text_sha256, recipe of every row, staged; names that prove ambiguous are drawn anew."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    while not verified(docs, seed):
        seed += 1
    rows = docs.withColumn("chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return stage(rows.mapInArrow(_recipes(seed), "doc_id long, chars long, text_sha256 string, recipe binary")
                 .withColumn("row", F.monotonically_increasing_id()), "recipes")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty, and all empty texts are equal. Of a
    group the row with the most code points in its original text stays, then the smallest doc_id, null ids last;
    of rows that repeat id and text one stays. Other columns are ignored; an empty table gives none.
    """
    rows = recipes(docs)
    best = F.max(F.struct("chars", F.bitwise_not("doc_id").alias("rest"), F.bitwise_not("row").alias("last")))
    groups = rows.groupBy("recipe").agg(best.alias("best"), F.count("*").alias("group_size"))
    return join_hot(rows, stage(groups, "groups"), ["recipe"], "group_size").select(
        "doc_id", F.bitwise_not("best.rest").alias("keep_id"), "group_size",
        (F.col("row") == F.bitwise_not("best.last")).alias("kept"), "text_sha256")
