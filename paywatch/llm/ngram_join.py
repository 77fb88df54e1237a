r"""Near duplicates by an exact Jaccard join on word n-grams.

Documents with the same set of n-grams form a class; the join runs on classes. N-grams are ordered rare first, by counts
of n-grams and words over the whole corpus. Two sets with a Jaccard similarity of at least t share an n-gram among the first
n - ceil(t n) + 1 of each, so only those prefixes are joined. Sizes (length filter), places of the shared n-gram (positional filter)
and sizes of 64 hash ranges of both sets (suffix filter: what each range can share at most) throw out pairs; the rest are verified
on whole sets, each pair once.

Only groups are asked for, so no list of a prefix n-gram is turned into all its pairs. In each of a few rounds every class
is compared with one head of its lists, the member that shares most of its n-grams with others and was no head yet; classes
that link are one component. Lists within one component are done. In the lists that are left, all pairs of different components that can link
are compared, so no link between components is lost. A list with thousands of near copies costs thousands of comparisons.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import join_hot, mix, slices, utf8
from paywatch.session import stage, unstage

GRAMS, WORDS = 1 << 18, 1 << 20  # counters of n-grams and of words
BLOCK = 1 << 14
ROUNDS = 2
SLICE = 1 << 20  # bytes of texts at a time: working memory is about 25 times as much
RANGES = 64
SALTS = 64
BUCKETS = 1 << 20
ROW = ("doc_id long, key long, size int, sig1 long, sig2 long, prefix array<long>, ranges binary")


def shingles(column: pa.Array, k: int):
    """64-bit hashes of every text's word n-grams in order, A-Z in lower case; the border of each text; hashes of all words; for
    each n-gram its first word and its number of words. A text with fewer words has one n-gram of all its words; one without words none."""
    data, borders = utf8(column)
    data = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    column = pa.StringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(data))
    words = pc.ascii_split_whitespace(column)
    coded = words.flatten()
    filled = pc.not_equal(coded, "").to_numpy(zero_copy_only=False)  # white space at an end leaves empty words
    count = np.concatenate([[0], np.cumsum(filled)])
    ends = count[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])]
    coded = coded.filter(pa.array(filled)).dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    words = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(hashes) else hashes
    sizes = np.diff(ends)
    per_row = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    out_ends = np.concatenate([[0], np.cumsum(per_row)])
    first = np.arange(out_ends[-1]) + np.repeat(ends[:-1] - out_ends[:-1], per_row)
    length = np.repeat(np.minimum(sizes, k), per_row)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    out = length.astype(np.uint64)
    for j in range(k):
        factor = np.uint64(xxhash.xxh64_intdigest(b"word", j + 1) | 1)
        out += np.where(length > j, mix(padded[first + j]) * factor, np.uint64(0))
    return mix(out), out_ends, words, first, length


def at_most(tables: np.ndarray, hashes, words, first, length, k: int) -> np.ndarray:
    """For each n-gram a number of times that it doesn't exceed in the corpus: the least count of itself and its words."""
    out = tables[(hashes & np.uint64(GRAMS - 1)).astype(np.int64)]
    of_words = np.append(tables[GRAMS + (words & np.uint64(WORDS - 1)).astype(np.int64)], np.zeros(k, tables.dtype))
    for j in range(k):
        out = np.where(length > j, np.minimum(out, of_words[first + j]), out)
    return out


def sets(column: pa.Array, k: int):
    """Yields the sorted distinct n-gram hashes of each text."""
    hashes, borders, *_ = shingles(column, k)
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
        part = np.sort(hashes[a:b])
        yield part[np.concatenate([[True], part[1:] != part[:-1]])] if b > a else part


def _count(k):
    def run(batches):
        counts = np.zeros(GRAMS + WORDS, np.int64)
        for part in slices(batches, "text", SLICE):
            hashes, _, words, *_ = shingles(part.column("text"), k)
            counts[:GRAMS] += np.bincount((hashes & np.uint64(GRAMS - 1)).astype(np.int64), minlength=GRAMS)
            counts[GRAMS:] += np.bincount((words & np.uint64(WORDS - 1)).astype(np.int64), minlength=WORDS)
        if counts.any():
            blocks = counts.astype("<u4" if counts.max() < 1 << 32 else "<u8").reshape(-1, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())],
                names=["block", "counts"])

    return run


def _sum(frame):
    total = sum(np.frombuffer(c, "<u4" if len(c) == 4 * BLOCK else "<u8").astype("<u8") for c in frame["counts"])
    return frame.iloc[:1].assign(counts=[total.tobytes()])


def frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """How many n-grams, and how many words, of all documents fall on each of a fixed number of hash values: bounds on
    their counts. Words are few against texts, so bounds on rare words are sharp, and most texts have rare words; a counter of
    n-grams shows those that stand out. The order that follows is the same for all documents, which is all that exactness needs."""
    blocks = docs.select("text").mapInArrow(_count(k), "block int, counts binary")
    blocks = blocks.withColumn("salt", F.spark_partition_id() % SALTS)
    parts = blocks.groupBy("block", "salt").applyInPandas(_sum, "block int, counts binary, salt int")
    whole = parts.groupBy("block").applyInPandas(_sum, "block int, counts binary, salt int")
    out = np.zeros(GRAMS + WORDS, np.uint64)
    for r in whole.select("block", "counts").collect():
        out[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.counts, "<u8")
    return np.minimum(out, (1 << 32) - 1).astype(np.uint32)


def _describe(k, percent, tables):
    def run(batches):
        for part in slices(batches, "text", SLICE):
            rows = []
            hashes, borders, *more = shingles(part.column("text"), k)
            bound = at_most(tables, hashes, *more, k)
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                order = np.argsort(hashes[a:b], kind="stable")
                own = hashes[a:b][order]
                new = np.ones(len(own), bool)
                new[1:] = own[1:] != own[:-1]
                own, rarity = own[new], bound[a:b][order][new]
                n = len(own)
                # Pairs with 100 * shared >= percent * union share at least ceil(percent * n / 100).
                first = n - -(-percent * n // 100) + 1 if n else 0
                order = np.argsort(rarity, kind="stable")[:first]
                mixed = mix(own)
                sums = mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed * np.uint64(0x9E3779B97F4A7C15))
                sums = [int(np.uint64(s).astype(np.int64)) for s in sums]
                ranges = np.bincount((own >> np.uint64(58)).astype(np.int64), minlength=RANGES).astype("<u4").tobytes()
                rows.append((n, *sums, own[order].view(np.int64), ranges))
            n, sig1, sig2, prefix, ranges = zip(*rows)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(p) for p in prefix])]), pa.int32()),
                pa.array(np.concatenate(prefix), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.array(n, pa.int32()), pa.array(sig1, pa.int64()),
                 pa.array(sig2, pa.int64()), lists, pa.array(ranges, pa.binary())],
                names=["doc_id", "key", "size", "sig1", "sig2", "prefix", "ranges"])

    return run


def _whole(k):
    def run(batches):
        for part in slices(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([s.tobytes() for s in sets(part.column("text"), k)], pa.binary())],
                names=["node", "members"])

    return run


def _verify(percent):
    def run(batches):
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            good = []
            for a, b in zip(left, right):
                both = np.sort(np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    return run


def _may_share(percent):
    """Suffix filter: the ranges of two sets can share no more than the smaller of their sizes."""
    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, RANGES).astype(np.int64)
                    for c in ("ranges_a", "ranges_b"))
            shared = np.minimum(a, b).sum(1)
            good = 100 * shared >= percent * (a.sum(1) + b.sum(1) - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    return run


def _narrowed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the length and the suffix filter."""
    info = nodes.select("node", "size", "ranges")
    for side in "ab":
        pairs = pairs.join(info.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"),
                                       F.col("ranges").alias(f"ranges_{side}")), side)
    least, most = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return pairs.where(least * 100 >= most * percent).mapInArrow(_may_share(percent), "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets, as a table. Sets are made from the texts of the classes in question: a
    broadcast of at most BUCKETS hash values keeps most other texts out of the shuffle, and the join is exact."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    asked = asked.join(nodes.select("node", "rep"), "node").select(
        "node", F.col("rep.doc_id").alias("id"), F.col("rep.key").alias("key"))
    asked = stage(asked, "asked")
    buckets = F.broadcast(asked.select(F.pmod("key", F.lit(BUCKETS)).alias("bucket")).distinct())
    texts = docs.join(buckets, F.pmod(F.xxhash64("text"), F.lit(BUCKETS)) == F.col("bucket"), "left_semi")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("key"))
    texts = texts.join(asked, same).select("node", "text")
    whole = stage(texts.mapInArrow(_whole(k), "node long, members binary"), "sets")
    members = whole.dropDuplicates(["node"])
    rows = pairs.join(members.select(F.col("node").alias("a"), F.col("members").alias("left")), "a")
    rows = rows.join(members.select(F.col("node").alias("b"), F.col("members").alias("right")), "b")
    links = stage(rows.mapInArrow(_verify(percent), "a long, b long"), "links")
    unstage(asked, whole)
    return links


def _ordered(x, y):
    return F.greatest(x, y).alias("a"), F.least(x, y).alias("b")


def _compared(pairs: DataFrame, done, docs: DataFrame, nodes: DataFrame, k: int, percent: int):
    """(pairs that passed the filters, those of them that link); pairs in `done` are not compared again."""
    if done is not None:
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    pairs = stage(_narrowed(pairs, nodes, percent), "pairs")
    return pairs, _verified(pairs, docs, nodes, k, percent)


def _mixed(entries: DataFrame, roots: DataFrame):
    """The entries, with their component, of lists that hold several components; and the components."""
    rows = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rows.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return stage(rows.join(mixed.select("gram"), "gram"), "mixed"), roots


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge (a, b): the smallest node it reaches. Alternates large-star and small-star
    (Kiveris et al., 2014); a node with very many edges is only ever aggregated or joined, never listed."""
    edges = stage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        last, edges = edges, stage(small, "stars")
        unstage(last)
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _candidates(left: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share an n-gram of a list and pass the length and the positional filter.

    Of a pair that passes, the smaller set has its shared n-gram among the first (1 - t) / (1 + t) of its n-grams, so only such
    entries are joined with all; and sizes must lie in neighbouring bands, so most pairs that can't pass are never formed. Texts from one
    template that don't link have the template's n-grams behind their own, and form none. Large lists are dealt out.
    """
    def band(size):
        return size.cast("int") if percent >= 100 else F.floor(F.log(size.cast("double")) / float(np.log(100 / percent))).cast("int")

    left = left.withColumns({c: F.col(c).cast("long") for c in ("size", "place")})
    b = left.select("gram", *[F.col(c).alias(f"{c}_b") for c in ("root", "node", "size", "place")], band(F.col("size")).alias("band"))
    a = left.where(F.col("place") * (100 + percent) <= F.col("size") * (100 - percent))
    a = a.select("gram", *[F.col(c).alias(f"{c}_a") for c in ("root", "node", "size", "place")], F.explode(F.sequence(
        band(F.col("size")), band(F.expr(f"size * 100 div {percent}")))).alias("band"))
    many = b.groupBy("gram", "band").agg(F.count("*").alias("copies"))
    a = stage(a.join(many, ["gram", "band"]), "probes")
    # Nothing is shared before the first n-gram that a pair shares, so a pair that links passes at that one.
    most_shared = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    passes = (F.col("root_a") != F.col("root_b")) & (F.col("size_a") <= F.col("size_b")) & (
        F.col("size_a") * 100 >= F.col("size_b") * percent) & (
        most_shared * 100 >= (F.col("size_a") + F.col("size_b") - most_shared) * percent)
    return join_hot(b, a, ["gram", "band"]).where(passes).select(*_ordered(F.col("node_a"), F.col("node_b"))).distinct()


def grouped(docs: DataFrame, k: int, percent: int, rounds: int) -> DataFrame:
    """doc_id, key (a hash of the text), size, root of each document; the root, which names its component, is null for empty sets."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    tables = frequencies(docs, k)
    whole = stage(docs.withColumn("key", F.xxhash64("text")).mapInArrow(_describe(k, percent, tables), ROW), "prefixes")
    classes = whole.where("size > 0").groupBy("sig1", "sig2", "size").agg(
        F.min(F.struct("doc_id", "key")).alias("rep"),
        F.first("prefix").alias("prefix"), F.first("ranges").alias("ranges"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    rows = stage(whole.select("doc_id", "key", "size", "sig1", "sig2"), "documents")
    unstage(whole)  # prefixes are the largest table; from here only the lists need them

    # Size and place travel as one number: these rows are the largest shuffle.
    entries = classes.select("node", "size", F.posexplode("prefix").alias("place", "gram"))
    entries = entries.select("node", (F.shiftleft(F.col("size").cast("long"), 32) + F.col("place")).alias("both"), "gram")
    lists = entries.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    lists = stage(entries.join(lists, "gram").select(
        "gram", "node", F.shiftright("both", 32).cast("int").alias("size"),
        F.col("both").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("place")), "lists")
    nodes = stage(classes.drop("prefix"), "nodes")
    unstage(classes)
    # Members that share much come first in every list: an original before its edited copies.
    weights = lists.groupBy("node").agg(F.count("*").alias("weight"))
    entries = stage(lists.join(weights, "node").withColumn("rank", F.struct("weight", "node")), "ranked")
    unstage(lists)

    done = links = None
    left = entries.withColumn("root", F.col("node"))
    tops = left.select("gram", "rank").where("false")
    for _ in range(rounds):
        # Each list's highest member that was no head yet, against the members of other components.
        head = left.join(tops, ["gram", "rank"], "left_anti").groupBy("gram").agg(F.max(F.struct("rank", "root", "size")).alias("head"))
        head = stage(head, "heads")
        tops = tops.union(head.select("gram", "head.rank"))
        pairs = left.join(head, "gram").where(F.col("root") != F.col("head.root"))
        pairs = pairs.select(*_ordered(F.col("node"), F.col("head.rank.node"))).distinct()
        pairs, found = _compared(pairs, done, docs, nodes, k, percent)
        done = pairs if done is None else done.union(pairs)
        links = found if links is None else links.union(found)
        last, (left, roots) = left, _mixed(entries, components(links))
        unstage(last)
        if left.isEmpty():
            return _named(rows, nodes, roots)

    pairs = _candidates(left, percent)
    _, found = _compared(pairs, done, docs, nodes, k, percent)
    return _named(rows, nodes, components(links.union(found)))


def _named(rows: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    named = nodes.select("node", "sig1", "sig2", "size").join(roots, "node", "left")
    named = named.select("sig1", "sig2", "size", F.coalesce("root", "node").alias("root"))
    full = rows.where("size > 0").join(named, ["sig1", "sig2", "size"])
    columns = ["doc_id", "key", "size", "root"]
    empty = rows.where("size = 0").withColumn("root", F.lit(None).cast("long"))
    return stage(full.select(*columns).union(empty.select(*columns)), "groups")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when 100 * shared >= percent * union of their sets of k-word n-grams (A-Z in lower case);
    component_id is the smallest doc_id that links lead to. Null and empty texts, and those of white space, have an empty set,
    link with nothing and are their own component. Rows that repeat are in one component. A null doc_id gives no component
    its name: a document that reaches null ids only has a null component_id. Other columns are ignored; an empty table gives none.
    """
    rows = grouped(docs, k, percent, rounds)
    best = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("copies"))
    full = join_hot(rows.where("root is not null"), stage(best, "components"), ["root"]).select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id")
    empty = rows.where("root is null").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, rounds: int = ROUNDS) -> DataFrame:
    """The rows of `docs`, with their columns, of one document of each component: the smallest doc_id (null ids last), then the smallest
    hash of the text; of rows that repeat both, one. Documents with an empty set all stay."""
    rows = grouped(docs, k, percent, rounds).withColumn("order", F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    best = rows.where("root is not null").groupBy("root").agg(F.min("order").alias("order"))
    best = best.select(F.col("order.doc_id").alias("_id"), F.col("order.key").alias("_key"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("_own"))
    full = F.coalesce("doc.text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key"))
    kept = packed.where(full).join(best, same).dropDuplicates(["_id", "_key"]).select("doc.*")
    return kept.unionByName(packed.where(~full).select("doc.*"))
