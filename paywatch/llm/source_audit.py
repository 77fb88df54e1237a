r"""Source divergence audit: how far the words of each source lie from those of the other sources of its language.

Terms that few documents of a language hold say nothing and are most of all terms. They are left out by iceberg refinement: documents
are counted by the first bytes of their terms; prefixes in too few documents are discarded with all that begins with them, the others
are extended, level by level, until complete terms remain. A document counts once for a prefix, however many of its terms begin with it,
so its terms are listed in order and a prefix is counted where it changes. What a level kept reaches the next as a table of bits of a
fixed size (a bit may let a few more through, whose own counts then discard them).

Then kept terms are counted by language and source, and pairs of sources are compared in blocks: BLOCK sources against BLOCK
sources over a chunk of about CHUNK terms, so no task holds more, whatever the number of sources and terms.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from paywatch.llm.common import join_hot, mix, slices, utf8
from paywatch.session import stage

# Fixed values of the contract.
LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10

FIRST = 4  # bytes of the first level's prefixes; each level has twice as many
MOST_BITS = 23  # 1 MB
SLICE = 2 << 20  # bytes of terms, about 2 ** 18 of them
BLANK = 32  # stands in no term
BLOCK, CHUNK = 128, 1024

IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


def _blobs(borders: np.ndarray, data: np.ndarray) -> pa.Array:
    """The stretches of `data` between `borders`."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(borders) - 1, [
        None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(data.tobytes())])


def _content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls and the row borders in them."""
    borders = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[borders[0]:borders[-1]], borders - borders[0]


def _terms(batches):
    """The distinct terms of each text in byte order, each with a blank behind it, and how often each stands there, four bytes a number:
    two byte strings a document, for rows of many small elements cost the JVM more than the counting."""
    for part in slices(batches, "text"):
        data, borders = utf8(part.column("text"))
        solid = IS_TERM[data]
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        begins = borders[:-1][borders[:-1] < len(data)]
        starts[begins] = solid[begins]
        places = np.flatnonzero(starts)
        row = np.searchsorted(borders, places, side="right") - 1
        of = np.flatnonzero(solid)
        ends = np.append(np.searchsorted(of, places), len(of)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(places), [
            None, pa.py_buffer(ends), pa.py_buffer(SMALL[data[of]].tobytes())]).dictionary_encode()
        many = max(1, len(words.dictionary))
        order = pc.array_sort_indices(words.dictionary)
        rank = np.empty(many, np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        each, counts = np.unique(row * many + rank[words.indices.to_numpy(zero_copy_only=False)], return_counts=True)
        per_row = np.bincount(each // many, minlength=len(part))
        letters, ends = _content(words.dictionary.take(order).take(pa.array(each % many)))
        upto = np.concatenate([[0], np.cumsum(per_row)])
        joined = np.full(len(letters) + len(each), BLANK, np.uint8)
        term = np.ones(len(joined), bool)
        term[ends[1:] + np.arange(len(each))] = False
        joined[term] = letters
        yield pa.RecordBatch.from_arrays(
            [part.column("lang"), part.column("source"), _blobs(ends[upto] + upto, joined), _blobs(4 * upto, counts.astype("<i4"))],
            names=["lang", "source", "terms", "counts"])


def _bytes(terms: pa.Array):
    """All bytes, padded, and begin and length of each term."""
    begin = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    data = terms.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return np.concatenate([data, np.zeros(8, np.uint8)]), begin[:-1], np.diff(begin)


def hashes(terms: pa.Array, lang: np.ndarray, most: int | None = None) -> np.ndarray:
    """Of (hash of the language, the first `most` bytes of each term), eight bytes at a time."""
    data, begin, length = _bytes(terms)
    length = length if most is None else np.minimum(length, most)
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = mix(lang + length.astype(np.uint64))
    at, part = np.arange(len(terms)), 0
    while len(at):
        left = length[at] - 8 * part
        word = words[begin[at] + 8 * part] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.clip(8 - left, 0, 7)).astype(np.uint64))
        out[at] = mix(out[at] * np.uint64(0x9E3779B97F4A7C15) + np.where(left > 0, word, np.uint64(0)))
        part += 1
        at = at[left > 8]
    return out


def lang_hashes(column: pa.Array) -> np.ndarray:
    coded = column.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(x) for x in coded.dictionary.to_pylist()], np.uint64)
    return known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(len(column), np.uint64)


def _bits(number: int):
    def run(batches):
        table = np.zeros(number // 8, np.uint8)
        for batch in batches:
            at = (hashes(batch.column("term"), lang_hashes(batch.column("lang"))) % np.uint64(number)).astype(np.int64)
            np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
        words = table.view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(words[at])], names=["word", "bits"])

    return run


class Kept:
    """Bits of hashes of (language, term)."""

    def __init__(self, rows: DataFrame, count: int):
        """`rows` has columns lang and term (binary); no more than 2 ** MOST_BITS bits reach driver and tasks."""
        number = 1 << min(MOST_BITS, max(10, (8 * count).bit_length()))
        words = np.zeros(number // 64, np.int64)
        found = rows.select("lang", "term").mapInArrow(_bits(number), "word int, bits long")
        for r in found.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
            words[r.word] = r.bits
        self.table = words.view(np.uint8)

    def holds(self, values: np.ndarray) -> np.ndarray:
        at = (values % np.uint64(8 * len(self.table))).astype(np.int64)
        return (self.table[at >> 3] >> (at & 7)) & 1 == 1


def _postings(part: pa.RecordBatch):
    """The row of each term, and the terms of all rows."""
    data, borders = _content(part.column("terms"))
    solid = data != BLANK
    ends = np.flatnonzero(~solid)
    row = np.repeat(np.arange(len(part)), np.diff(np.searchsorted(ends, borders)))
    return row, _blobs(np.concatenate([[0], ends - np.arange(len(ends))]), data[solid])


def _counted(length: int, kept: Kept | None):
    """Documents by language and the first `length` bytes of their terms, of terms that the level before let through."""
    def run(batches):
        for part in slices(batches, "terms", SLICE):
            row, terms = _postings(part)
            langs = part.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            size = pc.binary_length(terms).to_numpy(zero_copy_only=False)
            if kept is not None:
                longer = np.flatnonzero(size > length // 2)
                terms = terms.take(pa.array(longer))
                good = kept.holds(hashes(terms, lang_hashes(part.column("lang"))[row[longer]], length // 2))
                row, size, terms = row[longer][good], size[longer][good], terms.filter(pa.array(good))
            coded = pc.binary_slice(terms, 0, length).dictionary_encode()
            many = max(1, len(coded.dictionary))
            prefix = 2 * coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + (size <= length)
            new = np.ones(len(prefix), bool)
            new[1:] = (row[1:] != row[:-1]) | (prefix[1:] != prefix[:-1])
            each, docs = np.unique(lang[row[new]] * (2 * many) + prefix[new], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(each // (2 * many))), coded.dictionary.take(pa.array(each % (2 * many) // 2)),
                 pa.array(each % 2 == 1), pa.array(docs, pa.int64())], names=["lang", "term", "complete", "docs"])

    return run


def _summed(kept: Kept):
    """Occurrences by language, source and term, of terms that may be kept ones."""
    def run(batches):
        for part in slices(batches, "terms", 2 * SLICE):
            row, terms = _postings(part)
            good = kept.holds(hashes(terms, lang_hashes(part.column("lang"))[row]))
            row, coded = row[good], terms.filter(pa.array(good)).dictionary_encode()
            counts = _content(part.column("counts"))[0].view("<i4")[good]
            langs, sources = (part.column(c).dictionary_encode() for c in ("lang", "source"))
            lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] for x in (langs, sources))
            wide, many = max(1, len(sources.dictionary)), max(1, len(coded.dictionary))
            each, which = np.unique((lang * wide + source) * many + coded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
            sums = np.bincount(which, counts, len(each)).astype(np.int64)
            group = each // many
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(group // wide)), sources.dictionary.take(pa.array(group % wide)),
                 coded.dictionary.take(pa.array(each % many)), pa.array(sums)], names=["lang", "source", "term", "n"])

    return run


def postings(docs: DataFrame) -> DataFrame:
    """lang, source, terms, counts of each document (see `_terms`)."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return stage(rows.mapInArrow(_terms, "lang string, source string, terms binary, counts binary"), "postings")


def kept_terms(lists: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term) of terms in at least `least` documents of the language, by iceberg refinement of prefixes."""
    found, kept, length = None, None, FIRST
    while True:
        level = lists.select("lang", "terms").mapInArrow(
            _counted(length, kept), "lang string, term binary, complete boolean, docs long")
        level = level.groupBy("lang", "term", "complete").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        level = stage(level.drop("docs"), "prefixes")
        whole = level.where("complete").select("lang", "term")
        found = whole if found is None else found.union(whole)
        longer = level.where("not complete").select("lang", "term")
        many = longer.count()
        if not many:
            return stage(found, "kept-terms")
        kept, length = Kept(longer, many), 2 * length


def _share(n, total) -> np.ndarray:
    """1 + floor(SCALE * (n + 2) / total), digit by digit in base 1000: exact for totals up to 9 * 10 ** 15."""
    whole, rest = np.divmod(np.asarray(n, np.int64) + 2, total)
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return whole + 1


def _shares(rows: DataFrame, n: str, total: str, name: str) -> DataFrame:
    """Adds what `_share` gives, by the same digits."""
    rows = rows.withColumns({"_whole": F.expr(f"({n} + 2) div {total}"), "_rest": F.expr(f"({n} + 2) % {total}")})
    for _ in range(3):
        rows = rows.withColumns({"_whole": F.expr(f"_whole * 1000 + (_rest * 1000) div {total}"), "_rest": F.expr(f"(_rest * 1000) % {total}")})
    return rows.withColumn(name, F.col("_whole") + 1).drop("_whole", "_rest")


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q)**2 // (p + q)


def _compared(block: int):
    """Sums over a chunk of terms for the pairs of two blocks of sources."""
    def run(batches):
        for batch in batches:
            names = ("lang", "terms", "block_a", "block_b", "totals_a", "totals_b")
            plain = {c: batch.column(c).to_pylist() for c in names}
            borders = {x: batch.column(f"cells_{x}").offsets.to_numpy() for x in "ab"}
            cells = {x: [batch.column(f"cells_{x}").values.field(c).to_numpy() for c in ("no", "rank", "n")] for x in "ab"}
            for row in range(batch.num_rows):
                r = {c: plain[c][row] for c in names}
                mine = {x: [c[borders[x][row]:borders[x][row + 1]] for c in cells[x]] for x in "ab"}
                seen = np.unique(np.concatenate([mine["a"][0], mine["b"][0]]))
                sides, zeros = [], []
                for x in "ab":
                    first, totals = block * r[f"block_{x}"], np.array(r[f"totals_{x}"], np.int64)
                    zero = _share(0, totals)
                    table = np.repeat(zero[None, :], len(seen), axis=0)
                    no, place, n = mine[x]
                    table[np.searchsorted(seen, no), place - first] = _share(n, totals[place - first])
                    sides.append(table)
                    zeros.append(zero)
                value = (r["terms"] - len(seen)) * _distance(zeros[0][:, None], zeros[1][None, :])
                for i in range(value.shape[0]):
                    value[i] += _distance(sides[0][:, i:i + 1], sides[1]).sum(0)
                a, b = np.meshgrid(np.arange(value.shape[0]) + block * r["block_a"], np.arange(value.shape[1]) + block * r["block_b"], indexing="ij")
                keep = a < b
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["lang"]] * int(keep.sum()), pa.string()), pa.array(a[keep], pa.int32()), pa.array(b[keep], pa.int32()),
                     pa.array(value[keep], pa.int64())], names=["lang", "a", "b", "value"])

    return run


def _pairs(groups: DataFrame, chunks: DataFrame, terms: DataFrame, counts: DataFrame, block: int) -> DataFrame:
    """lang, a, b, value for ranks a < b of a language's sources."""
    blocks = groups.groupBy("lang", (F.col("rank") / block).cast("int").alias("block")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "total"))), lambda x: x["total"]).alias("totals"))
    sizes = terms.groupBy("lang", "chunk").agg(F.count("*").alias("terms"))
    cells = counts.groupBy("lang", "chunk", (F.col("rank") / block).cast("int").alias("block")).agg(
        F.collect_list(F.struct("no", "rank", "n")).alias("cells"))
    none = F.array().cast("array<struct<no:bigint,rank:int,n:bigint>>")
    cells = chunks.join(blocks, "lang").join(cells, ["lang", "chunk", "block"], "left").withColumn("cells", F.coalesce("cells", none))
    left, right = (cells.select("lang", "chunk", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "totals", "cells")]) for s in "ab")
    work = left.join(right, ["lang", "chunk"]).where("block_a <= block_b").join(sizes, ["lang", "chunk"], "left")
    work = work.withColumn("terms", F.coalesce("terms", F.lit(0).cast("long")))
    sums = work.mapInArrow(_compared(block), "lang string, a int, b int, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """One row per group (lang, source) and item: lang, source, part, item, value, rank.

    Part `pair` has every other source of the language with the divergence of the two; part `term` has the `top` terms that set the
    group off from its language. Null lang, source and text count as ''; rows that repeat are documents of their own; empty texts, and
    those without terms, give their group its rows. A term may be as long as a text. Equal values are ranked by item. A
    language with one source has no pairs. Other columns are ignored; an empty table gives none.
    """
    lists = postings(docs)
    found = kept_terms(lists, least)
    langs = lists.select("lang").distinct().join(found.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left")
    langs = langs.select("lang", F.coalesce("v", F.lit(0).cast("long")).alias("v")).withColumn(
        "chunks", F.ceil(F.col("v") / chunk).cast("int"))
    langs = stage(langs, "langs")
    named = join_hot(found.withColumn("no", F.monotonically_increasing_id()), langs, ["lang"], "v")
    terms = stage(named.select(
        "lang", "term", "no", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk")), "terms")
    counts = lists.mapInArrow(_summed(Kept(found, found.count())), "lang string, source string, term binary, n long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(terms, ["lang", "term"])
    counts = stage(counts, "term-counts")

    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("sum"))
    groups = lists.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stage(groups.select("lang", "source", place.alias("rank"), (F.coalesce("sum", F.lit(0)) + 2 * F.col("v")).alias("total")), "groups")

    # By chunk, too: the terms of a large group and of a large language find their totals in many places.
    spread = langs.select("lang", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.col("chunks")) - 1)).alias("chunk"))
    placed = counts.join(groups.join(spread, "lang").select("lang", "source", "chunk", "rank", "total"), ["lang", "source", "chunk"])
    pairs = _pairs(groups, spread, terms, placed.select("lang", "chunk", "no", "rank", "n"), block)
    pairs = pairs.union(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", "source", "rank")
    pairs = pairs.join(names.select("lang", "source", F.col("rank").alias("a")), ["lang", "a"])
    pairs = pairs.join(names.select("lang", F.col("source").alias("item"), F.col("rank").alias("b")), ["lang", "b"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    overall = counts.groupBy("lang", "chunk", "term").agg(F.sum("n").alias("lang_n"))
    whole = counts.groupBy("lang").agg(F.sum("n").alias("sum")).join(langs, "lang").select("lang", (F.col("sum") + 2 * F.col("v")).alias("lang_total"))
    overall = overall.join(whole.join(spread, "lang"), ["lang", "chunk"])
    rows = placed.select("lang", "source", "chunk", "term", "n", "total").join(overall, ["lang", "chunk", "term"])
    rows = _shares(_shares(rows, "n", "total", "p"), "lang_n", "lang_total", "q").where("p > q")
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                       F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(rows)
