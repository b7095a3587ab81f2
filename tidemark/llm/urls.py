"""Operator 10 (native): URL filter by rules and logistic regression on hashed character n-grams.

DataFrame functions only. Distinct character n-grams of host and path are hashed
into `DIM` buckets; a logistic regression is fitted on a small labelled URL table
and its weights, `DIM` numbers, become a literal of the scoring expression, so
scoring is one narrow pass over the url column. Rules come first: the longest
rule whose host is the url's or a parent of it, and whose path the url's path
starts with, decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIM = 1024
GRAMS = (3, 4)
CUT = 0.5

#: The rules of the contract, (action, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: The small labelled URL table, 1 is unwanted.
LABELLED = [
    ("https://en.wikipedia.example.org/wiki/History", 0),
    ("https://docs.python.example.net/3/library/os.html", 0),
    ("http://www.university.example.com/research/papers/1204", 0),
    ("https://news.daily.example.org/world/2021/05/article-7731", 0),
    ("https://blog.science.example.net/en/10293", 0),
    ("https://www.museum.example.com/de/39547.html", 0),
    ("https://library.city.example.org/fr/35610", 0),
    ("https://forum.gardening.example.net/t/tomatoes/4412", 0),
    ("https://www.weather.example.com/de/23755", 0),
    ("https://recipes.kitchen.example.org/en/19167/", 0),
    ("https://archive.example.net/details/lecture-12", 0),
    ("http://m.travel.example.com/en/29167/guide.html", 0),
    ("https://www.government.example.org/services/tax", 0),
    ("https://health.example.net/en/conditions/asthma", 0),
    ("https://maps.example.com/route/9912", 0),
    ("https://www.parliament.example.org/es/debates/551", 0),
    ("http://casino-bonus.example.org/free-spins/win", 1),
    ("https://xxx-videos.example.net/adult/hot/3312", 1),
    ("http://cheap-pills.example.com/buy/viagra-online", 1),
    ("https://poker-slots.example.org/bet/jackpot", 1),
    ("http://ads.tracker.example.net/click?id=881&ref=spam", 1),
    ("http://download-crack.example.com/keygen/warez.exe", 1),
    ("https://free-money.example.org/loan/payday/apply-now", 1),
    ("http://sexcams.example.net/live/adult/room9", 1),
    ("https://replica-watches.example.com/cheap/buy-now", 1),
    ("http://torrent-warez.example.org/download/crack", 1),
    ("https://win-prize.example.net/free/gift-card", 1),
    ("http://seo-links.example.com/buy/backlinks/cheap", 1),
    ("https://crypto-doubler.example.org/free/bitcoin", 1),
    ("http://pills-pharmacy.example.net/cheap/order", 1),
    ("https://betting-odds.example.com/casino/bonus", 1),
    ("http://adult-dating.example.org/hot/singles", 1),
]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    h = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Name and action of the longest rule that fits, else nulls."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, action = F.when(fits, h + p).otherwise(name), F.when(fits, act).otherwise(action)
    return name, action


def gram_ids(host: Column, path: Column) -> Column:
    """Distinct buckets of the n-grams of `^host` and `path$`."""


    def grams(tag: str, text: Column, n: int) -> Column:
        at = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substring(text, i, F.lit(n))), F.lit(DIM)).cast("int"))

    parts = [grams(tag, text, n) for tag, text in (("h", F.concat(F.lit("^"), host)), ("p", F.concat(path, F.lit("$")))) for n in GRAMS]
    return F.array_distinct(F.concat(*parts))


def fit(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights and intercept from `url, label`; the table is small by contract. Rows with a null are left out."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = labelled.where("url is not null and label is not null").select(F.col("label").cast("double").alias("label"), gram_ids(host_of(F.col("url")), path_of(F.col("url"))).alias("ids"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(DIM - 1)), lambda i: F.when(F.array_contains(F.col("ids"), i), 1 / F.sqrt(F.size("ids"))).otherwise(0.0))
    # a small table: one task a round instead of one a core
    model = LogisticRegression(maxIter=60, regParam=0.003, standardization=False).fit(rows.select("label", array_to_vector(dense).alias("features")).coalesce(1))
    return [round(float(w), 6) for w in model.coefficients], round(float(model.intercept), 6)


def probability(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    ids = gram_ids(host, path)
    w = F.lit(weights)
    total = F.aggregate(ids, F.lit(0.0), lambda s, i: s + F.get(w, i))
    return 1 / (1 + F.exp(-(F.lit(intercept) + F.coalesce(total / F.sqrt(F.nullif(F.size(ids), F.lit(0))), F.lit(0.0)))))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """`page_id, host, path, rule, verdict, p_block` of every row.

    A url that is null or lacks `://` has an empty host and path, no rule, and
    the method's verdict on two empty strings. Urls of any length are read whole,
    equal rows get equal results, an empty table gives one. Other columns are
    dropped.
    """
    spark = pages.sparkSession
    labelled = labelled_urls(spark) if labelled is None else labelled
    weights, intercept = fit(labelled)
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, action = _rule(F.col("host"), F.col("path"), rules)
    scored = base.withColumn("rule", name).withColumn("__action", action).withColumn("p_block", probability(F.col("host"), F.col("path"), weights, intercept))
    verdict = F.coalesce("__action", F.when(F.col("p_block") >= CUT, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")


def labelled_urls(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"('{u}', {y})" for u, y in LABELLED)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)")
