r"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every text is split by each pattern once; matches and the gaps between them give positions. Values become SHA-256
hashes, which are counted by distinct repositories and owners over the whole corpus. A value with few owners and in few
repositories looks live; one that many owners have, or that stands in many repositories of one owner, is a copied example.
Long mixed tokens outside the base patterns are added as `token` when they look live and as `copied` when not.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from paywatch.llm.common import join_hot
from paywatch.session import stage

# Fixed values of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of 24 and more among all maximal runs
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "token", "copied")
MAX_OWNERS = 2  # a credential may be shared with one other owner
MAX_REPOSITORIES = 4


def _found(text: Column, order: int) -> Column:
    pattern = (ASSIGN, ACCESS, HEX, TOKEN)[order]
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                         F.split(text, pattern, -1).alias("gap"))

    def entry(z: Column) -> Column:
        value = F.regexp_extract(z["m"], ASSIGN, 2) if order == 0 else z["m"]
        good = {
            0: F.length(value) >= 6,
            1: F.length(value) >= 20,
            2: F.lit(True),
            3: value.rlike("[0-9]") & value.rlike("[A-Z]") & (value.rlike("[a-z]") | value.rlike("^[0-9A-F]{24,}$")),
        }[order]
        return F.struct(F.lit(order).alias("kind"), F.length(z["gap"]).cast("long").alias("gap"),
                        F.length(z["m"]).cast("long").alias("size"), good.alias("good"), F.sha2(value, 256).alias("hash"))

    found = F.transform(F.filter(pairs, lambda z: z["m"].isNotNull()), entry)
    return F.when(text.rlike(pattern), found)


def _listed(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")


def ownership(values: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each hash. Partial sums come first, so a hash that a third of all rows
    hold reaches each task as a few rows."""
    each = values.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    each = each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return each.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
                                    F.sum("n").alias("occurrences"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository=("source", "lang"),
                 max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, max_owners, max_repositories.

    Null and empty texts have no span. A null owner or repository is one owner or repository of its own. Repeated
    rows each get their row. `n_live` counts spans whose value has at most `max_owners` owners and stands in at most
    `max_repositories` repositories, `n_copied` the others; `max_owners` and `max_repositories` in the result are the largest
    numbers of owners and repositories of one of its values, 0 without any.
    Positions are code points, however long the text. Other columns are ignored; an empty table gives none.
    """
    text = F.coalesce("text", F.lit(""))
    found = F.concat(*[F.coalesce(_found(text, k), F.array().cast(
        "array<struct<kind:int,gap:bigint,size:bigint,good:boolean,hash:string>>")) for k in range(4)])
    rows = stage(docs.select(
        F.col("doc_id").cast("long"), F.col(owner).alias("owner"), F.struct(*repository).alias("repository"),
        found.alias("found"), F.monotonically_increasing_id().alias("row")), "secrets")

    # Matches are few; a window over those of one text turns gaps and sizes into positions.
    each = rows.where(F.size("found") > 0).select("row", "owner", "repository", F.posexplode("found").alias("i", "f"))
    upto = Window.partitionBy("row", "f.kind").orderBy("i")
    each = each.withColumn("end", F.sum(F.col("f.gap") + F.col("f.size")).over(upto)).where("f.good").select(
        "row", "owner", "repository", F.col("f.hash").alias("hash"), F.col("f.kind").alias("kind"),
        (F.col("end") - F.col("f.size")).alias("start"), "end")
    each = stage(each, "secret-spans")

    judged = join_hot(each, stage(ownership(each), "secret-owners"), ["hash"], "occurrences")
    judged = judged.withColumn("live", (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories))
    judged = judged.withColumn("kind", F.when((F.col("kind") == 3) & ~F.col("live"), 4).otherwise(F.col("kind")))
    spans = judged.groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"), F.count(F.when(~F.col("live"), 1)).alias("n_copied"),
        F.max("owners").alias("max_owners"), F.max("repositories").alias("max_repositories"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    out = rows.select("row", "doc_id").join(spans, "row", "left").withColumn("all", F.coalesce("all", none))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "doc_id", count("n_assign"), count("n_access"), count("n_hex"),
        F.sha2(_listed(F.filter("all", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"), count("n_live"), count("n_copied"), count("max_owners"),
        count("max_repositories"))
