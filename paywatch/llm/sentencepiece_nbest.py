"""SentencePiece encoding with the N best segmentations, and decoding.

The piece lattice of a text is cut wherever two neighbouring characters stand next to each other in no piece: no path
crosses such a border, so the best path is the chain of the units' best paths. Every different unit is solved once by a
forward Viterbi pass. Its scores are also exact heuristics of an A-star search that runs backward from a unit's end and yields
its paths in falling order of score. A text's N best paths differ from the best one in at most the N - 1 places where a second path costs
least, so A-star runs on those units only and their lists are merged.

Scores are whole numbers in this vocabulary, so sums are exact. Characters without a piece become their UTF-8 bytes.
"""

import heapq
import struct
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from paywatch.llm.common import slices, utf8

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
NONE = 1 << 62  # the gap of a unit with one path
MEMORY = 150_000  # solved units that a worker keeps, each as one byte string: four workers may share an executor of two cores
LONG = 64
SLICE, CODES = 1 << 19, 1 << 17  # bytes of texts to encode and ids to decode at a time: working memory is about 50 times as many bytes
HEAD = struct.Struct("<qq")
LAST: dict = {}  # what may follow where nothing may
NOTHING = (None, LAST)

_loaded: dict[str | None, "Pieces"] = {}


class Kept:
    """At most `limit` entries: when half of them are new, those that were not asked for since the last time go."""

    def __init__(self, limit: int):
        self.half, self.new, self.old = limit // 2, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None:
            value = self.old.pop(key, None)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value):
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Pieces:
    """Vocabulary, the pairs of characters inside pieces, and the units solved so far."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.scores, self.ids, self.bytes = {}, {}, {}
        self.texts = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.texts.append(b"")
            else:
                shown = piece.replace(BLANK, " ")
                self.scores[shown], self.ids[shown] = int(model.get_score(i)), i
                self.texts.append(shown.encode())
        self.unknown = min(self.scores.values()) - 10
        # By character: the score of what was read so far, if that is a piece, and what may follow (LAST: nothing).
        prefixes = sorted({p[:k] for p in self.scores for k in range(1, len(p) + 1)})
        inner, below = {p[:-1] for p in prefixes}, {}
        for p in prefixes:
            below[p] = {} if p in inner else LAST
            (below[p[:-1]] if len(p) > 1 else below.setdefault("", {}))[p[-1]] = (self.scores.get(p), below[p])
        self.trie = below.get("", {})
        # Numbers of characters: 0 stands for all without a piece.
        chars = sorted({c for p in self.scores for c in p})
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.scores:
            n = self.number[[ord(c) for c in p]]
            self.joined[n[:-1], n[1:]] = True
        self.solved = Kept(MEMORY)  # by text: score, gap, ids
        self.listed = Kept(MEMORY // 10)  # by text and n: score and ids of each path
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(self.texts), np.uint8)

    def edges(self, text: str):
        """For each start, the pieces of the lattice as (end, score)."""
        size, out, first = len(text), [], self.trie.get
        for i in range(size):
            here, at, j = [], first(text[i]), i
            if at is None or at[0] is None:
                here.append((i + 1, self.unknown))
            while at is not None:
                j += 1
                if at[0] is not None:
                    here.append((j, at[0]))
                at = at[1].get(text[j]) if j < size else None
            out.append(here)
        return out

    def pieces(self, text: str) -> list[int]:
        found = self.ids.get(text)
        return [found] if found is not None else [self.bytes[b] for b in text.encode()]

    def solve(self, text: str) -> tuple[bytes, int, int]:
        """Ids of the best path, its score, and how much less the second path scores. Of equal paths the one with
        the longer pieces at its end is the best."""
        known = self.solved.get(text)
        if known is not None:
            return known[HEAD.size:], *HEAD.unpack_from(known)
        # Scores of the best and of the second path to each place: the second comes by the best edge from a second path, or by
        # another edge from a best one.
        size, first = len(text), self.trie.get
        best, second, back = [0] + [-NONE] * size, [-NONE] * (size + 1), [0] * (size + 1)
        for i in range(size):
            base, low = best[i], second[i]
            j, at = i, first(text[i])
            if at is None or at[0] is None:
                at, score = at or NOTHING, self.unknown
            else:
                score = at[0]
            while True:
                j += 1
                if score is not None:
                    total, old = base + score, best[j]
                    if total > old:
                        best[j], back[j] = total, i
                        score += low
                        second[j] = old if old > score else score
                    elif total > second[j]:
                        second[j] = total
                if j == size:
                    break
                at = at[1].get(text[j])
                if at is None:  # no piece begins like this
                    break
                score = at[0]
        j, ids, known = size, [], self.ids
        while j:
            i = back[j]
            piece = known.get(text[i:j])
            if piece is None:
                ids += reversed(self.pieces(text[i:j]))
            else:
                ids.append(piece)
            j = i
        ids.reverse()
        out = (array("H", ids).tobytes(), best[size], NONE if second[size] < -NONE // 2 else best[size] - second[size])
        if size <= LONG:
            self.solved.put(text, HEAD.pack(out[1], out[2]) + out[0])
        return out

    def nbest(self, text: str, n: int) -> list[tuple[int, list[int]]]:
        """The n best paths as (score, ids): A-star from the end, with the forward Viterbi score of a place as the exact
        heuristic of what lies before it. Of equal paths those closer to the start go first, then longer pieces."""
        known = self.listed.get((text, n))
        if known is not None:
            return [(score, np.frombuffer(ids, np.uint16).tolist()) for score, ids in known]
        lattice, size = self.edges(text), len(text)
        before = [0] + [-NONE] * size
        into = [[] for _ in range(size + 1)]
        for i, here in enumerate(lattice):
            for j, score in here:
                before[j] = max(before[j], before[i] + score)
                into[j].append((i, score))
        out, tick = [], 0
        queue = [(-before[size], size, 0, 0, None)]
        while queue and len(out) < n:
            _, place, _, gained, tail = heapq.heappop(queue)
            if not place:
                ids, at = [], 0
                while tail:
                    end, tail = tail
                    ids += self.pieces(text[at:end])
                    at = end
                out.append((gained, ids))
                continue
            for i, score in into[place]:
                tick += 1
                heapq.heappush(queue, (-(before[i] + score + gained), i, tick, score + gained, (place, tail)))
        if size <= LONG:
            self.listed.put((text, n), tuple((score, np.array(ids, np.uint16).tobytes()) for score, ids in out))
        return out

    def units(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The texts, each behind a blank, cut into units; and the border of each text in them."""
        shown = pc.binary_join_element_wise(" ", pc.fill_null(column, ""), "")
        data, borders = utf8(shown)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        number = self.number[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.joined[number[:-1], number[1:]]
        cut[np.searchsorted(lead, borders[:-1])] = True
        starts = lead[cut]
        units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)),
                                            pa.py_buffer(data.tobytes()))
        return units, np.searchsorted(starts, borders)


def loaded(path: str | None) -> Pieces:
    if path not in _loaded:
        import public_tokenizers

        _loaded[path] = Pieces(path or public_tokenizers.path(MODEL))
    return _loaded[path]


def merged(lists: list[list[tuple[int, list[int]]]], n: int) -> list[tuple[int, tuple]]:
    """The n best choices of one path from each list, as (score, index in each list)."""
    best = [(0, ())]
    for paths in lists:
        best = sorted(((-(s + score), chosen + (k,)) for s, chosen in best for k, (score, _) in enumerate(paths)))[:n]
        best = [(-s, chosen) for s, chosen in best]
    return best


def _encode(n, path):
    def run(batches):
        pieces = loaded(path)
        for part in slices(batches, "text", SLICE):
            units, borders = pieces.units(part.column("text"))
            coded = units.dictionary_encode()
            keys = coded.dictionary.to_pylist()
            solved = [pieces.solve(k) for k in keys]
            which = coded.indices.to_numpy(zero_copy_only=False)
            sizes = np.array([len(s[0]) // 2 for s in solved], np.int64)
            pool = np.frombuffer(b"".join(s[0] for s in solved), np.uint16)
            starts = np.cumsum(sizes) - sizes
            lengths = sizes[which]
            ends = np.cumsum(lengths)
            ids = pool[np.arange(ends[-1]) + np.repeat(starts[which] - (ends - lengths), lengths)].astype(np.int32)
            at = np.concatenate([[0], ends])
            score = np.concatenate([[0], np.cumsum(np.array([s[1] for s in solved], np.int64)[which])])
            gaps = np.array([s[2] for s in solved], np.int64)[which]
            scores, changes = [], []
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                near = np.argsort(gaps[a:b], kind="stable")[:n - 1] + a
                near = np.sort(near[gaps[near] < NONE]).tolist()
                lists = [pieces.nbest(keys[which[u]], n) for u in near]
                ranked = merged(lists, n)
                total = int(score[b] - score[a])
                scores.append([total + s - ranked[0][0] for s, _ in ranked])
                changes.append([
                    {"rank": r, "start": int(at[u] - at[a]), "length": int(at[u + 1] - at[u]), "ids": lists[i][k][1]}
                    for r, (_, chosen) in enumerate(ranked) if r for i, (u, k) in enumerate(zip(near, chosen))
                    if lists[i][k][1] != ids[at[u]:at[u + 1]].tolist()])
            yield pa.RecordBatch.from_arrays([
                *part.columns, pa.ListArray.from_arrays(pa.array(at[borders], pa.int32()), pa.array(ids)),
                pa.array(scores, pa.list_(pa.int64())), pa.array(changes, CHANGES)],
                names=[*part.schema.names, "ids", "scores", "changes"])

    return run


CHANGES = pa.list_(pa.struct([("rank", pa.int32()), ("start", pa.int32()), ("length", pa.int32()),
                              ("ids", pa.list_(pa.int32()))]))


def encode(docs: DataFrame, n: int = 4, path: str | None = None) -> DataFrame:
    """doc_id, text, ids of the best segmentation, scores of the n best, and changes: where one of rank 1 and up replaces
    `length` ids from `start` by its own.

    A text has fewer scores where its lattice has fewer paths. Null counts as empty: its only piece is the blank that
    stands before every text. A literal U+2581 is kept as its bytes. Null ids and repeated rows each keep their row;
    other columns are ignored; an empty table gives none. Texts of any length are read whole.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encode(n, path), "doc_id long, text string, ids array<int>, scores array<long>, "
                           "changes array<struct<rank: int, start: int, length: int, ids: array<int>>>")


def _decode(path):
    def run(batches):
        pieces = loaded(path)
        for part in slices(batches, "ids", CODES):
            column = pc.fill_null(part.column("ids"), pa.scalar([], pa.list_(pa.int32())))
            ids = column.flatten().to_numpy(zero_copy_only=False)
            count = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            sizes = pieces.sizes[ids]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            data = pieces.pool[np.arange(total) + np.repeat(pieces.starts[ids] - (ends - sizes), sizes)]
            borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])].tolist()
            whole = data.tobytes()
            texts = [whole[a:b].decode(errors="replace").removeprefix(" ") for a, b in zip(borders[:-1], borders[1:])]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                             names=[*part.schema.names, "decoded"])

    return run


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Adds `decoded`, the text of the column `ids` (null: none). Bytes that are not UTF-8 become U+FFFD."""
    rows = rows.drop("decoded")
    return rows.mapInArrow(_decode(path), StructType([*rows.schema.fields]).add("decoded", StringType()))


def nbest_ids(ids, changes, rank):
    """Ids of the segmentation of a rank, as an expression on the columns of `encode`."""
    mine = F.filter(changes, lambda c: c["rank"] == rank)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(mine, start, lambda s, c: F.struct(
        (c["start"] + c["length"]).alias("at"),
        F.concat(s["out"], F.slice(ids, s["at"] + 1, c["start"] - s["at"]), c["ids"]).alias("out")),
        lambda s: F.concat(s["out"], F.slice(ids, s["at"] + 1, F.size(ids))))
