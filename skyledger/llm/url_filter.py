"""Allow or block urls: given rules first, then logistic regression on hashed character n-grams.

Everything is DataFrame expressions. The labelled table is small by contract (``MOST_LABELLED`` rows), so gradient
descent runs on one coefficient per labelled url: from zero, each step adds a multiple of each url's features to the weights,
so the weights are always a sum of the urls' features, and the scores of the labelled urls need only their shared n-grams.
One expression runs all rounds; the weights are then summed per bucket. Judging a page is a projection: no
shuffle, and the model is ``BUCKETS`` numbers whatever the number of pages.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most labelled urls to learn from; the rounds take the square of their number.
MOST_LABELLED = 1000
#: Buckets of the n-gram hash, a prime.
BUCKETS = 65_521
#: Multipliers of the code points of an n-gram, first to last.
FACTORS = (31_337, 7_919, 104_729, 15_485_863, 611_953)
#: Part of the url, length of its n-grams, and what their hashes are moved by, so that kinds don't meet.
KINDS = (("host", 3, 11), ("host", 4, 101), ("host", 5, 1009), ("path", 3, 10_007), ("path", 4, 30_011))
ROUNDS = 400
DECAY = 0.0005
_ROWS = "array<struct<url:string,label:int,buckets:array<int>>>"

# Made-up site names, labelled by hand.
BAD_NAMES = (
    "casino-royal", "online-casino", "lucky-casino", "jackpot-slots", "mega-slots", "poker-stars-win", "win-big-now", "win-cash",
    "sports-bets", "best-bets", "bets365", "betting-tips", "free-spins", "free-money", "free-gifts", "adult-videos",
    "adult-dating", "adults-only", "xxx-movies", "hot-xxx", "porn-tube", "free-porn", "sex-cams", "live-sex-x",
    "cheap-viagra", "cheap-meds", "cheap-watches", "diet-pills", "pills-online", "buy-pills-now", "spam-links", "link-spam",
    "link-farm", "content-farm", "seo-farm", "click-ads", "ads-server", "ads-banner", "banner-track", "web-tracker",
    "user-track", "crack-warez", "warez-keygen", "malware-drop", "pokerroom", "poker-online", "warezbox", "free-warez",
    "slots-palace", "fun-slots", "viagra-store", "order-viagra", "porn-clips", "pornzone", "casinoplay", "bet-and-win",
)
GOOD_NAMES = (
    "weather", "morning-news", "thunder", "thornton", "thesis", "other", "nation", "station", "motion", "theatre", "northern",
    "heather", "anderson", "reading", "garden", "kitchen", "library", "museum", "hospital", "school", "university", "cooking",
    "recipes", "travel-notes", "train-times", "bus-lines", "city-guide", "history-club", "science-daily", "open-source",
    "python-help", "linux-users", "music-lessons", "art-gallery", "book-review", "film-notes", "local-news", "sports-club",
    "running", "bicycle", "farmers-market", "green-house", "teacher", "children", "family-health", "dentist", "winter-sports",
    "window-shop", "adventure", "better-life", "alphabet", "traction", "essex", "shelter", "ballet", "chess", "ocean",
    "island", "mountain", "river", "forest", "harbour", "bridge", "castle", "village", "market", "theology", "notation",
    "rotation", "mother", "table", "hand", "whale", "shoulder", "restaurant", "ethernet", "earth", "month",
)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def default_labels(spark: SparkSession) -> DataFrame:
    """The names of this module as ``url, label``; schemes, subdomains, domains and paths go round within each label, so they tell nothing."""
    rows = []
    for label, names in ((1, BAD_NAMES), (0, GOOD_NAMES)):
        for i, name in enumerate(names):
            front = ("http://", "https://www.", "https://m.", "http://blog.", "https://")[i % 5]
            end = (".example.com", ".example.net", ".example.org", ".test")[i // 2 % 4]
            rows.append((f"{front}{name}{end}/{('en', 'fr', 'de', 'es')[i // 3 % 4]}/{1 + 37 * i}", label))
    return spark.createDataFrame(rows, "url string, label int")


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _codes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.ascii(c))


def _grams(codes: Column, length: int, moved: int) -> Column:
    """The bucket of each n-gram. The zipped copies are one array, so no lambda reads another array again."""
    names = [f"c{i}" for i in range(length)]
    zipped = F.arrays_zip(*[F.slice(codes, i + 1, F.size(codes)).alias(name) for i, name in enumerate(names)])

    def bucket(chars: Column) -> Column:
        total = F.lit(moved).cast("long")
        for name, factor in zip(names, FACTORS, strict=False):
            total = total + chars[name].cast("long") * factor
        return (total % BUCKETS).cast("int")

    return F.array_compact(F.transform(zipped, bucket))


def url_features(host: Column, path: Column) -> Column:
    """Buckets of the distinct n-grams of a url, ascending. The host stands between dots, so that its labels have edges."""
    codes = {"host": _codes(F.concat(F.lit("."), host, F.lit("."))), "path": _codes(path)}
    return F.sort_array(F.array_distinct(F.concat(*[_grams(codes[part], n, moved) for part, n, moved in KINDS])))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def url_weights(labelled: DataFrame) -> DataFrame:
    """Weight of each bucket that the labelled urls have, as ``bucket, weight``.

    ``labelled`` has ``url, label`` (1 to block); rows without a label don't count, equal rows count once each. More than ``MOST_LABELLED`` rows are
    an error. Features are of unit length. There is no constant: a url without a known n-gram has even odds, whatever the
    labelled urls' shares are. The step is the longest that surely descends: 4 over the greatest row sum of the
    inner products. Without labelled rows, or rows with n-grams, there are no weights.
    """
    known = labelled.select("url", F.col("label").cast("int").alias("label")).dropna(subset=["label"])
    features = known.select("url", "label", url_features(host_of(F.col("url")), path_of(F.col("url"))).alias("buckets"))
    rows = F.sort_array(F.collect_list(F.struct("url", "label", "buckets"))).alias("rows")
    gathered = features.agg(rows).select(
        F.when(F.size("rows") > MOST_LABELLED, F.raise_error(F.lit(f"more than {MOST_LABELLED} labelled urls")).cast(_ROWS))
        .otherwise(F.col("rows"))
        .alias("rows")
    )

    def product(a: Column, b: Column) -> Column:
        shared = F.size(F.array_intersect(a["buckets"], b["buckets"]))
        norm = F.sqrt(F.greatest(F.size(a["buckets"]) * F.size(b["buckets"]), F.lit(1)).cast("double"))
        return shared / norm

    products = F.transform("rows", lambda a: F.transform("rows", lambda b: product(a, b)))
    start = F.struct(
        products.alias("products"),
        F.transform("rows", lambda r: r["label"].cast("double")).alias("labels"),
        F.transform("rows", lambda r: F.lit(0.0)).alias("parts"),
    )
    ready = gathered.select("rows", start.alias("start"))
    step = F.lit(4.0) / F.greatest(F.array_max(F.transform(F.col("start.products"), _sum)), F.lit(1.0))
    ready = ready.select("rows", F.col("start").withField("step", step).alias("start"))

    def descend(state: Column, _: Column) -> Column:
        def moved(row: Column, i: Column) -> Column:
            score = _sum(F.zip_with(row, state["parts"], lambda p, a: p * a))
            miss = F.get(state["labels"], i) - F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
            return F.get(state["parts"], i) * (F.lit(1.0) - DECAY) + state["step"] * miss

        return state.withField("parts", F.transform(state["products"], moved))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    fitted = ready.select("rows", F.aggregate(rounds, F.col("start"), descend, lambda state: state["parts"]).alias("parts"))
    each = fitted.select(F.explode(F.arrays_zip("rows", "parts")).alias("x")).select(
        F.col("x.rows.buckets").alias("buckets"), F.col("x.parts").alias("part")
    )
    share = F.col("part") / F.sqrt(F.size("buckets").cast("double"))
    return each.select(F.explode("buckets").alias("bucket"), share.alias("share")).groupBy("bucket").agg(F.sum("share").alias("weight"))


def url_score(host: Column, path: Column, weights: dict[int, float]) -> Column:
    """Log odds that a url is one to block, by the weights of ``url_weights``."""
    dense = [0.0] * BUCKETS
    for bucket, weight in weights.items():
        dense[bucket] = weight
    # One literal that the optimizer folds into an array; as many expressions as buckets would be slow to plan.
    table = F.split(F.lit(" ".join(map(repr, dense))), " ").cast("array<double>")
    buckets = url_features(host, path)
    known = _sum(F.transform(buckets, lambda b: F.get(table, b)))
    return known / F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame) -> DataFrame:
    """Each row of ``pages`` with ``host, path, rule, verdict, score``.

    The longest rule that fits decides (of equally long ones the one given first), else the score: block above even odds.
    Null and odd urls have an empty host and path; they fit no rule, score zero and are allowed. Long urls are read
    whole, in time proportional to their length. Equal rows are judged alike and all stay; an empty table gives an empty one. Other columns of
    ``pages`` pass through, but those of the five names are replaced; only ``url`` is read.
    """
    weights = {row.bucket: row.weight for row in url_weights(labelled).collect()}
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parted = pages.withColumns({"host": host, "path": path})
    rule = verdict = F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: len(r.text)):
        fits = one.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(one.text)).otherwise(rule)
        verdict = F.when(fits, F.lit(one.verdict)).otherwise(verdict)
    judged = parted.withColumns({"rule": rule, "verdict": verdict, "score": url_score(F.col("host"), F.col("path"), weights)})
    learnt = F.when(F.col("score") > 0, "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce("verdict", learnt))
