r"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is read as tokens, its k-mers are numbered by occurrence, and each numbered k-mer has one hash. The hash
circle is cut at `parts` points; behind each point the `size` next hashes select that many k-mers, their order in the
text is restored, and the tuple is hashed to one component of the signature. Equal components need the same k-mers in
the same order, so likeness falls with edits and with moved passages. One hash for each k-mer serves all components; a text
with fewer k-mers than points goes around the circle, so no component is empty.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from paywatch.llm.common import let

# Words, those longer than 16 code points in pieces.
TOKEN = r"[^\x20\x09-\x0D]{1,16}"
KMER, PARTS, SIZE = 3, 64, 2
PLACE = 30  # bits of a packed number that hold the place; a text of 2 GB has no more tokens


def kmers(text: Column, k: int = KMER, token: str = TOKEN) -> Column:
    """Sorted array<long>: a hash of each k-mer in the upper bits, its place in the lower. A text with fewer than k
    tokens is one k-mer; one without any has an empty array."""
    words = F.transform(F.regexp_extract_all(text, F.lit(token), F.lit(0)), lambda x: F.xxhash64(x))
    packed = let(words, lambda w: F.when(F.size(w) > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))),
        lambda i: _pack(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), i))).otherwise(F.array().cast("array<bigint>")))
    return F.sort_array(packed)


def _pack(hashed: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftright(hashed, PLACE), PLACE).bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE) - 1))


def _heads(items: Column, key) -> Column:
    """Indexes at which a sorted array starts a new key."""
    return F.filter(F.sequence(F.lit(0), F.size(items) - 1),
                    lambda i: (i == 0) | (key(F.get(items, i)) != key(F.get(items, i - 1))))


def numbered(packed: Column) -> Column:
    """Hashes of (k-mer, occurrence), again packed with the place and sorted. Runs of equal k-mers are ordered by
    place, so the occurrence is the index within the run."""
    key = lambda x: F.shiftright(x, PLACE)

    def run(items: Column, heads: Column):
        def one(head: Column, j: Column) -> Column:
            last = F.coalesce(F.get(heads, j + 1), F.size(items)) - 1
            return F.transform(F.sequence(head, last), lambda i: _pack(
                F.xxhash64(key(F.get(items, i)), i - head), _place(F.get(items, i))))

        return F.flatten(F.transform(heads, one))

    found = let(packed, lambda items: let(_heads(items, key), lambda heads: run(items, heads)))
    return F.sort_array(F.when(F.size(packed) > 0, found).otherwise(packed))


def components(items: Column, parts: int = PARTS, size: int = SIZE) -> Column:
    """array<int> with one component for each point of the circle, from `numbered` k-mers."""
    bits = parts.bit_length() - 1
    part = lambda x: F.shiftright(x, 64 - bits) + parts // 2

    def of(items: Column, heads: Column) -> Column:
        found = F.transform(heads, lambda h: F.struct(part(F.get(items, h)).alias("part"), h.alias("at")))

        def one(found: Column, p: Column) -> Column:
            first = F.coalesce(F.get(F.filter(found, lambda f: f["part"] >= p), F.lit(0))["at"], F.lit(0))
            taken = F.transform(F.sequence(F.lit(0), F.least(F.lit(size), F.size(items)) - 1), lambda r: let(
                F.get(items, (first + r) % F.size(items)),
                lambda x: F.struct(_place(x).alias("place"), F.shiftright(x, PLACE).alias("hash"))))
            return F.shiftright(F.xxhash64(F.transform(F.sort_array(taken), lambda t: t["hash"])), 32).cast("int")

        return let(found, lambda f: F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: one(f, p)))

    empty = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.lit(0))
    return F.when(F.size(items) > 0, let(items, lambda i: let(_heads(i, part), lambda h: of(i, h)))).otherwise(empty)


def with_signature(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds `name`, the array of components of column `text`."""
    rows = rows.withColumn(name, kmers(F.col(text)))
    rows = rows.withColumn(name, numbered(F.col(name)))
    return rows.withColumn(name, components(F.col(name)))


def _hexed(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda c: F.right(F.concat(F.lit("0000000"), F.lower(F.hex(
        c.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))), F.lit(8))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return equal / F.size(a)


def _bucket(at: Column, bounds: list[int]) -> Column:
    """Number of bounds below `at`, by binary search."""
    all_bounds = F.lit(bounds) if bounds else F.array().cast("array<bigint>")
    steps = max(1, len(bounds).bit_length())
    span = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def halve(s: Column, _) -> Column:
        mid = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.get(all_bounds, mid) < at
        done = s["low"] >= s["high"]
        return F.struct(F.when(done | ~below, s["low"]).otherwise(mid + 1).alias("low"),
                        F.when(done | below, s["high"]).otherwise(mid).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), span, halve, lambda s: s["low"])


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds `next`, a struct of `columns` of the next document by descending doc_id; the first follows the last.

    Ids are cut into ranges at values of the column, so ranges are sorted in parallel, and the documents at a
    range's upper end are given to the range above as its guests: its last document finds its next one there.
    Of equal ids the larger hash of the text goes first; null ids come last.
    """
    docs = docs.withColumn("at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx("at", [i / n for i in range(1, n + 1)], 100 * n)).first()[0] or []
    bounds = sorted({int(b) for b in found})
    inner, top = bounds[:-1], bounds[-1] if bounds else 0

    own = _bucket(F.col("at"), inner)
    bound = F.array_contains(F.lit(inner), F.col("at")) if inner else F.lit(False)
    guest = F.when(F.col("at") == top, F.lit(0)).when(bound, own + 1)
    spots = F.filter(F.array(F.struct(own.alias("bucket"), F.lit(False).alias("guest")),
                             F.struct(guest.alias("bucket"), F.lit(True).alias("guest"))), lambda s: s["bucket"].isNotNull())
    rows = docs.withColumn("spot", F.explode(spots))
    order = Window.partitionBy("spot.bucket").orderBy(
        F.col("spot.guest"), F.desc("at"), F.desc(F.xxhash64("text")), F.desc("text"))
    return rows.withColumn("next", F.lead(F.struct(*columns)).over(order)).where("not spot.guest").drop("spot", "at")


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null counts as empty; an empty text has the fingerprint of zeros. A single document is its own next one. Null
    and repeated ids are ordered as `with_next` says; other columns are ignored; an empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_signature(rows, "text", "own"), ["text", "own"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited_text", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next.text", F.lit(1), half)))
    rows = rows.select("doc_id", "n_chars", "own", F.col("next.own").alias("following"), "edited_text",
                       F.sha2("edited_text", 256).alias("edited_sha256"))
    rows = with_signature(rows, "edited_text", "edited")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", _hexed(F.col("own")).alias("fingerprint"),
        _hexed(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"))
