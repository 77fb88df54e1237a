r"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens, and a queue earns credit at its share of all tokens. Whenever the credit that a
queue has not yet spent (its deficit) reaches a quantum, the next quantum of its tokens is served; the stream of
served tokens is cut into windows of 2048. A quantum is what the target gives the queue in one window, so every window
by itself holds the target proportions; only queues that are due fewer than LEAST tokens in a window wait for more
than one window until they have that many.

Serving order has a closed form: quantum k of a queue with m quanta is due when the share (k + 1) / m of the whole is
served. The place of a quantum is then the sum, over the queues, of the quanta due earlier; only the
totals of the queues are needed, so each partition computes its own windows and deficits carry over partitions
without a pass from one to the next. Only the last window can be short. A quantum of a fixed number of tokens, the same for
all queues, can be asked for.
"""

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from paywatch.llm.common import buckets, slices, utf8
from paywatch.session import stage

WINDOW = 2048
LEAST = 16
MEMORY = 200_000  # encoded units that a worker keeps, about: some 200 bytes each
VOCABULARY = "word_bpe_49k.json"
END = 1

# Kinds of bytes for cutting: 1 ASCII letters, 2 ASCII signs except the apostrophe, 3 white space, 0 all others.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[[c for c in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)) if c != ord("'")]] = 2
KINDS[[9, 10, 11, 12, 13, 32]] = 3
LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")

_known: dict[str | None, "Units"] = {}


class Units:
    """Encoded units of one vocabulary, up to MEMORY of them, as one array of ids."""

    def __init__(self, path: str | None):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        # Strings that the tokenizer takes out of a text before anything else, as they are written.
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError("added tokens that depend on what is around them")
        added = sorted((t.content.encode() for t in added), key=lambda x: (-len(x), x))
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.model = self.tokenizer.model
        # Byte-level vocabularies write a byte as this character.
        hidden = [*range(33), *range(127, 161), 173]
        self.shown = {b: chr(b) for b in range(256)} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.clear()

    def clear(self):
        self.numbers: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint16)
        self.ends = np.zeros(1 << 18, np.int64)

    def encode(self, unit: str) -> list[int]:
        if LATIN.fullmatch(unit):  # one run of small letters: nothing to normalise or to split
            return [t.id for t in self.model.tokenize("".join(map(self.shown.get, unit.encode())))]
        return self.tokenizer.encode(unit, add_special_tokens=False).ids

    def of(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First place and size, in `self.ids`, of each unit."""
        if len(self.numbers) > MEMORY:
            self.clear()
        numbers, count = self.numbers, len(self.numbers)
        new = [u for u in units if u not in numbers]
        found = [self.encode(u) for u in new]
        numbers.update(zip(new, range(count, count + len(new))))
        flat = np.fromiter(chain.from_iterable(found), np.int64)
        if len(flat) and flat.max() >= 1 << 16:
            raise ValueError("ids beyond 16 bits")
        used = int(self.ends[count])
        ends = used + np.cumsum([len(f) for f in found], dtype=np.int64)
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while count + len(new) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[used:used + len(flat)] = flat
        self.ends[count + 1:count + 1 + len(new)] = ends
        which = np.fromiter((numbers[u] for u in units), np.int64, len(units))
        return self.ends[which], self.ends[which + 1] - self.ends[which]


def added(data: np.ndarray, borders: np.ndarray, known: "Units") -> tuple[list, list]:
    """Begins and ends of the tokenizer's added strings that lie within one text."""
    begins, ends = [], []
    if known.added is not None:
        whole = data.tobytes()
        if known.added.search(whole):
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                found = [m.span() for m in known.added.finditer(whole, a, b)]
                begins += [x for x, _ in found]
                ends += [x for _, x in found]
    return begins, ends


def encode(texts: pa.Array, path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the border of each. This vocabulary drops white space and lowers case, and no token
    crosses white space or the border of an ASCII letter and a sign other than the apostrophe. So a text is the sequence of
    its units between such borders, and each different unit is encoded once; strings of added tokens are units, too. A-Z are lowered first where no other
    character than ASCII follows, which might combine with them."""
    data, borders = utf8(texts)
    if path not in _known:
        _known[path] = Units(path)
    known = _known[path]
    kinds = KINDS[data]
    before = np.concatenate([np.full(min(1, len(kinds)), 3, np.uint8), kinds[:-1]])
    cut = (before == 3) | (kinds + before == 3) & (kinds != 3) & (kinds != 0) & (before != 0)
    first = np.zeros(len(data) + 1, bool)
    first[borders[:-1]] = True
    cut |= first[:-1]
    begins, ends = added(data, borders, known)
    for a, b in zip(begins, ends):  # each of them is a unit of its own
        cut[a + 1:b] = False
        cut[a] = True
        cut[b:b + 1] = True
    plain = np.append(data[1:] < 128, True)[:len(data)] | np.append(first[1:-1], True)[:len(data)]
    for a, b in zip(begins, ends):
        plain[a:b] = False
    data = data + (((data >= 65) & (data <= 90) & plain) * np.uint8(32))
    keep = kinds != 3
    starts = np.flatnonzero((cut & keep)[keep])
    solid = data[keep]
    per_text = np.concatenate([[0], np.cumsum(cut & keep)])[borders]
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(solid)).astype(np.int32)),
                                        pa.py_buffer(solid.tobytes()))
    coded = units.dictionary_encode()
    firsts, sizes = known.of(coded.dictionary.to_pylist())
    which = coded.indices.to_numpy(zero_copy_only=False)
    lengths = sizes[which]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    ids = known.ids[np.arange(total) + np.repeat(firsts[which] - (ends - lengths), lengths)]
    return ids, np.concatenate([[0], ends])[per_text]


def _tokenise(path):
    def run(batches):
        for part in slices(batches, "text", 2 << 20):
            ids, borders = encode(part.column("text"), path)
            out = np.insert(ids, borders[1:], END).astype("<u2")  # id 1 behind each document
            sizes = np.diff(borders) + 1
            ends = np.cumsum(sizes) * 2
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [
                None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("queue"), data.cast(pa.binary()), pa.array(sizes, pa.int64())],
                names=["doc_id", "queue", "ids", "doc_tokens"])

    return run


def _queued(rows: DataFrame) -> DataFrame:
    """Adds `place`, the tokens before a row in its queue. Queues are cut into buckets by a hash of the row, sums run
    inside buckets in parallel, and sums of buckets are added; so a queue with a third of all rows spreads, too."""
    many = buckets(rows.sparkSession, 4)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(many)))
    sums = rows.groupBy("queue", "bucket").agg(F.sum("doc_tokens").alias("sum"))
    before = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("queue", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("queue", "bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("doc_tokens").over(inside), F.lit(0)))
    return rows.join(sums, ["queue", "bucket"]).withColumn("place", F.col("base") + F.col("inside"))


def due_before(ends: np.ndarray, queue: int, totals: list[int], quantum: int) -> np.ndarray:
    """Tokens of all queues served before the quantum of `queue` that ends at `ends` of its tokens.

    Quantum j of queue i ends at e = min((j + 1) * q, T_i) and goes first when e / T_i < end / T, or as early in a
    queue listed before. Exact in Python integers where 64 bits could overflow.
    """
    total, out = totals[queue], np.zeros(len(ends), np.int64)
    small = max(totals) < 1 << 31
    ends = ends.astype(np.int64) if small else ends.astype(object)
    for i, other in enumerate(totals):
        due = ends * other  # e < due / total (or <=)
        reached = due // total if i <= queue else -((-due) // total) - 1
        served = np.where(reached >= other, other, reached // quantum * quantum)
        if i == queue:
            served = np.where(ends >= total, (total - 1) // quantum * quantum, ends - quantum)
        out += served.astype(np.int64)
    return out


def quanta_of(totals: list[int], window: int, least: int = LEAST) -> list[int]:
    """How many quanta each queue is served in: one for each window, or fewer of `least` tokens or more."""
    windows, least = -(-sum(totals) // window), max(1, min(least, window // 2))
    return [min(windows, max(1, t // least)) for t in totals]


def _part(k: np.ndarray, total, count):
    """k * total // count without a product beyond 64 bits; k is at most `count`."""
    return k * (total // count) + k * (total % count) // count


def due_before_quanta(k: np.ndarray, queue: int, totals: list[int], counts: list[int]) -> np.ndarray:
    """Tokens of all queues served before quantum `k` of `queue`. Quantum j of queue i ends at (j + 1) * T_i // m_i of its
    tokens and goes first when (j + 1) / m_i < (k + 1) / m, or as early in a queue listed before."""
    out = np.zeros(len(k), np.int64)
    for i, (other, count) in enumerate(zip(totals, counts)):
        due = (k + 1) * count
        out += _part(k if i == queue else due // counts[queue] if i < queue else -(-due // counts[queue]) - 1, other, count)
    return out


def shares(place: np.ndarray, size: np.ndarray, queue: np.ndarray, totals: list[int], window: int, least: int = LEAST):
    """Parts of documents by quantum: arrays of document, start, length and position in the stream."""
    counts = quanta_of(totals, window, least)
    total, count = np.array(totals)[queue], np.array(counts)[queue]
    wide = max(t * c for t, c in zip(totals, counts)) >= 1 << 62

    def number(token):  # the last quantum that begins at or before the token
        token, many, all_ = (x.astype(object) if wide else x for x in (token, count, total))
        return (((token + 1) * many - 1) // all_).astype(np.int64)

    first = number(place)
    each = number(place + size - 1) - first + 1
    doc = np.repeat(np.arange(len(place)), each)
    k = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
    begins = _part(k, total[doc], count[doc])
    starts = np.maximum(begins, place[doc])
    lengths = np.minimum(_part(k + 1, total[doc], count[doc]), (place + size)[doc]) - starts
    at = starts - begins
    for q in np.unique(queue).tolist():
        mine = queue[doc] == q
        at[mine] += due_before_quanta(k[mine], q, totals, counts)
    return doc, starts, lengths, at


def _equal(place: np.ndarray, size: np.ndarray, queue: np.ndarray, totals: list[int], quantum: int):
    """As `shares`, for quanta of a fixed number of tokens."""
    first = place // quantum
    count = (place + size - 1) // quantum - first + 1
    doc = np.repeat(np.arange(len(place)), count)
    k = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    starts = np.maximum(k * quantum, place[doc])
    lengths = np.minimum((k + 1) * quantum, (place + size)[doc]) - starts
    at = starts - k * quantum
    ends = np.minimum((k + 1) * quantum, np.array(totals)[queue[doc]])
    for q in np.unique(queue).tolist():
        mine = queue[doc] == q
        at[mine] += due_before(ends[mine], q, totals, quantum)
    return doc, starts, lengths, at


def layout(place: np.ndarray, size: np.ndarray, queue: np.ndarray, totals: list[int], quantum: int | None, window: int,
           least: int = LEAST):
    """Pieces of documents: arrays of document, start, length and position in the stream, in the documents' order."""
    if quantum:
        doc, starts, lengths, at = _equal(place, size, queue, totals, quantum)
    else:
        doc, starts, lengths, at = shares(place, size, queue, totals, window, least)
    cut = at // window * window + window - at  # a quantum is no longer than a window: at most one cut
    two = np.flatnonzero(lengths > cut)
    doc, starts, at, lengths = (np.concatenate(x) for x in (
        (doc, doc[two]), (starts, starts[two] + cut[two]), (at, at[two] + cut[two]),
        (np.minimum(lengths, cut), lengths[two] - cut[two])))
    order = np.lexsort((starts, doc))
    doc, starts, at, lengths = doc[order], starts[order], at[order], lengths[order]
    # Pieces that follow each other in the same window are one piece.
    joined = np.zeros(len(starts), bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (at[1:] == at[:-1] + lengths[:-1]) & (at[1:] % window != 0)
    heads = np.flatnonzero(~joined)
    doc = doc[heads]
    return doc, starts[heads] - place[doc], np.add.reduceat(lengths, heads), at[heads]


def _dealt(placed: DataFrame, sizes: DataFrame, least: int) -> DataFrame:
    """Rows of small queues as parts, one for each quantum: row, parts as array<struct<start, length, place>>, `place` being the
    tokens before a part in one queue that all small ones make up. Quanta stand there in the order in which they are due,
    the first of each queue at a hashed place, else all of the smallest would be due at the end. They are ranked in buckets of equal
    shares of the whole, and sums of earlier buckets are added, so no table of all queues stands in one task."""
    many = F.greatest(F.lit(1), F.floor(F.col("sum") / least)).cast("long")
    phase = (F.pmod(F.xxhash64("queue"), F.lit(1 << 20)) + 1) / F.lit(1 << 20)
    rows = placed.join(sizes.select("queue", "sum", many.alias("many"), phase.alias("phase")), "queue")
    rows = rows.select("*", F.explode(F.expr(
        "sequence(((place + 1) * many - 1) div sum, ((place + doc_tokens) * many - 1) div sum)")).alias("k"))
    begin = F.expr("k * (sum div many) + k * (sum % many) div many")
    end = F.expr("(k + 1) * (sum div many) + (k + 1) * (sum % many) div many")
    rows = rows.select("row", "queue", "place", F.greatest(begin, "place").alias("start"),
                       F.least(end, F.col("place") + F.col("doc_tokens")).alias("end"), ((F.col("k") + F.col("phase")) / F.col("many")).alias("due"))
    cells = buckets(placed.sparkSession, 4)
    rows = rows.select("row", "queue", "due", "start", (F.col("start") - F.col("place")).alias("from"), (F.col("end") - F.col("start")).alias("length"),
                       F.least(F.floor(F.col("due") * cells), F.lit(cells - 1)).alias("bucket"))
    rows = stage(rows, "quanta")
    sums = rows.groupBy("bucket").agg(F.sum("length").alias("sum"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row for each bucket
    sums = sums.select("bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bucket").orderBy("due", "queue", "start").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(sums, "bucket")
    part = F.struct(F.col("from").alias("start"), "length", (F.col("base") + F.col("inside")).alias("place"))
    return rows.groupBy("row").agg(F.sort_array(F.collect_list(part)).alias("parts"))


def _parts(part: pa.RecordBatch):
    """Row, start in the row, length and place of each part; rows of large queues are one part."""
    place, size = (part.column(c).to_numpy() for c in ("place", "doc_tokens"))
    row, start = np.arange(len(place)), np.zeros(len(place), np.int64)
    if "parts" not in part.schema.names:
        return row, start, size, place
    lists = part.column("parts")
    known, flat = lists.is_valid().to_numpy(zero_copy_only=False), lists.flatten()
    many = np.where(known, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 1)
    row, inner = np.repeat(row, many), np.repeat(known, many)
    start, size, place = start[row], size[row], place[row]
    start[inner], size[inner], place[inner] = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "length", "place"))
    # Parts that follow each other in both are one.
    heads = np.ones(len(row), bool)
    heads[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + size[:-1])
    heads = np.flatnonzero(heads)
    return row[heads], start[heads], np.add.reduceat(size, heads), place[heads]


def _pieces(names: list, totals: list[int], quantum: int | None, window: int, least: int):
    """`names` are the large queues; if `totals` has one more entry, that is the queue of all others."""
    number = {q: i for i, q in enumerate(names)}

    def run(batches):
        for part in slices(batches, "ids"):
            queue = np.array([number.get(q, len(names)) for q in part.column("queue").to_pylist()])
            row, first, size, place = _parts(part)
            doc, start, length, at = layout(place, size, queue[row], totals, quantum, window, least)
            start, doc = start + first[doc], row[doc]
            size = part.column("doc_tokens").to_numpy()
            wide = memoryview(np.frombuffer(b"".join(part.column("ids").to_pylist()), "<u2").astype("<u4")).cast("B")
            begin = 4 * ((np.cumsum(size) - size)[doc] + start)
            sums = [zlib.crc32(wide[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist())]
            of = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(of), pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                 part.column("doc_tokens").take(of), pa.array(at // window), pa.array(at % window), part.column("queue").take(of)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    return run


def pack(docs: DataFrame, by: str = "source", window: int = WINDOW, quantum: int | None = None, path: str | None = None,
         least: int = LEAST) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue.

    Targets are the shares of the sources in all tokens, which lets every queue end with the last window. Quanta follow the
    targets unless `quantum` gives one number of tokens for all. Every source is a queue, however many there are; one that is due
    fewer than `least` tokens in a window is served that many at a time. A null source is a source. Null and
    empty texts are one token (id 1); rows that repeat are documents of their own; a long document takes as many
    windows as it needs. Other columns are ignored; an empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.concat(F.lit("="), F.col(by).cast("string")).alias("queue"), "text")
    rows = rows.withColumn("queue", F.coalesce("queue", F.lit("null")))
    rows = stage(rows.mapInArrow(_tokenise(path), "doc_id long, queue string, ids binary, doc_tokens long")
                 .withColumn("row", F.monotonically_increasing_id()), "tokens")

    sizes = rows.groupBy("queue").agg(F.sum("doc_tokens").alias("sum"))
    sizes = stage(sizes, "queues")
    total = sizes.agg(F.sum("sum")).first()[0] or 0
    # A queue is large if it is due a quantum of `least` tokens in each window: at most window / least of them are.
    least = max(1, min(least, window // 2))
    bound = 0 if quantum else least * -(-total // window)
    totals = {r.queue: r["sum"] for r in sizes.where(F.col("sum") >= bound).collect()}
    names = sorted(totals)
    totals = [totals[n] for n in names]
    placed = _queued(rows.select("row", "queue", "doc_tokens")).select("row", "queue", "doc_tokens", "place")
    kept = ["doc_id", "queue", "ids", "doc_tokens", "place"]
    if sum(totals) < total:
        totals.append(total - sum(totals))
        placed = stage(placed, "placed")
        parts = _dealt(placed, sizes.where(F.col("sum") < bound), least)
        placed, kept = placed.join(parts, "row", "left"), [*kept, "parts"]
    whole = rows.join(placed.drop("queue", "doc_tokens"), "row").select(*kept)
    return whole.mapInArrow(
        _pieces(names, totals, quantum, window, least),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string")
