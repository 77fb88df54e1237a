r"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The model is MLlib's, trained on a small labelled table (`SEEDS` by default, any DataFrame of url and label
otherwise), and scores inside the JVM. Only the url column is read.
"""

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
WIDTH = 1 << 14
SIZES = (3, 4, 5)
THRESHOLD = 0.6  # only what looks clearly unwanted

# The labelled table: unwanted and wanted hosts with the same kinds of subdomains and everyday paths, so that these tell
# nothing, and some telling paths.
UNWANTED = """
casino-royal.example.org online-casino.example.net lucky-slots.example.org best-bets.example.net free-spins.example.org
poker-win.example.net bet-now.example.org jackpot-winner.example.net sports-betting.example.org roulette.example.net
win-big.example.net bingo-win.example.org cheap-meds.example.net buy-pills.example.org discount-pharmacy.example.net
online-pills.example.org diet-pills.example.net cheap-viagra.example.org pills-shop.example.org ad-server.example.net
ads-network.example.org track-pixel.example.net adclick.example.org ads.example.net tracker.example.org popup-ads.example.net
track-ads.example.org spam-links.example.net link-farm.example.org content-farm.example.net seo-spam.example.org
cheap-backlinks.example.org spam.example.org doorway-farm.example.net free-iphone.example.org get-rich.example.net
easy-money.example.org prize-claim.example.net cheap-watches.example.org replica-bags.example.net cheap-loans.example.org
payday-loan.example.net hot-singles.example.org adult-cams.example.net xxx-videos.example.org porn-tube.example.net
adult-chat.example.org free-download.example.org warez-keys.example.net torrent-crack.example.org hack-tools.example.net
adult-zone.example.org adult-videos.example.net adult-dating.example.org xxx-adult.example.net nude-photos.example.org
gambling-bonus.example.net viagra-store.example.org malware-download.example.net
""".split()
WANTED = """
library.example.org museum.example.net university.example.org writer.example.net news.example.org weather.example.net
city.example.org recipes.example.net gardening.example.org docs.python.example.net history.example.org science.example.net
school.example.org travel.example.net hospital.example.org archive.example.net orchestra.example.org carpenter.example.net
cyclists.example.org maps.example.net parliament.example.org radio.example.net wiki.example.org encyclopedia.example.net
astronomy.example.org theatre.example.net journal.example.org institute.example.net observatory.example.org teacher.example.net
thornwood.example.org renthal.example.net onderia.example.org inthere.example.net statione.example.org andering.example.net
eastend.example.org hesterton.example.net therance.example.org atheon.example.net sheredan.example.org national-park.example.org
old-town.example.net water-supply.example.org open-data.example.net village-hall.example.org book-club.example.net
bird-watch.example.org hill-farmers.example.net railway.example.org thesaurus.example.net thistles.example.org thinkers.example.net mathshelp.example.org
thethings.example.net hearthshire.example.org earthshine.example.net themes.example.org
""".split()
SUBDOMAINS = ("", "www.", "blog.", "m.")
PATHS = ("/en/12", "/de/450/", "/fr/77.html", "/es/310?page=2", "/en/8#top", "/", "", "/en/901?utm_source=feed", "/about")
TELLING = (("/casino/play", 1.0), ("/claim-prize", 1.0), ("/buy/cheap-pills", 1.0), ("/free-bets", 1.0), ("/adclick/redirect", 1.0),
           ("/xxx/porn", 1.0), ("/research/papers", 0.0), ("/world/article-77", 0.0), ("/catalogue/books", 0.0),
           ("/council/minutes", 0.0), ("/tutorial/intro", 0.0), ("/images/m31.html", 0.0))
SEEDS = [(f"https://{SUBDOMAINS[i % 4]}{host}{PATHS[i % 9]}", label)
         for hosts, label in ((UNWANTED, 1.0), (WANTED, 0.0)) for i, host in enumerate(hosts)]
SEEDS += [(f"https://site{i}.example.org{path}", label) for i, (path, label) in enumerate(TELLING)]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first `://`: up to a slash, question mark or hash, and from there up to a question mark or hash."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, or null. A rule fits its host and all subdomains."""
    rule = verdict = F.lit(None).cast("string")
    # Shortest first: each later `when` that fits takes precedence. Of equally long rules the longer host wins, then block.
    for answer, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(answer)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, sizes=SIZES) -> Column:
    """Character n-grams of host and path, marked by where they stand. The look-ahead keeps it linear in the length."""
    parts = []
    for mark, part in (("h", host), ("p", F.translate(path, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))):
        text = F.concat(F.lit("^"), part, F.lit("$"))
        for n in sizes:
            every = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
            parts.append(_marked(every, mark))
    return reduce(lambda a, b: F.concat(a, b), parts)


def _marked(all_grams: Column, mark: str) -> Column:
    return F.transform(all_grams, lambda g: F.concat(F.lit(mark), g))


def _features(urls: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    return urls.withColumns({"host": host, "path": path}).withColumn("grams", grams(F.col("host"), F.col("path")))


def train(labelled: DataFrame, width: int = WIDTH) -> PipelineModel:
    """Fits on a small table of url and label (1: unwanted)."""
    rows = _features(labelled.where(F.col("url").isNotNull() & F.col("label").isNotNull())).cache()
    stages = [HashingTF(numFeatures=width, binary=True, inputCol="grams", outputCol="features"),
              LogisticRegression(regParam=0.01, maxIter=50, standardization=False)]
    model = Pipeline(stages=stages).fit(rows)
    rows.unpersist()
    return model


def seed_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEEDS, "url string, label double").coalesce(1)


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    A null url, or one without `://`, has an empty host and path; no rule fits it and the model judges the empty
    text. `score` is the model's probability of an unwanted page; rules go before it. Null ids, repeated rows and
    urls of any length each give their row; other columns are ignored; an empty table gives none.
    """
    model = train(seed_urls(pages.sparkSession) if labelled is None else labelled)
    scored = model.transform(_features(pages.select("page_id", "url")))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    score = vector_to_array("probability")[1]
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(score > threshold, "block").otherwise("allow")).alias("verdict"),
                         score.alias("score"))
