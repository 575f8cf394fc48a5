"""URL verdicts from rules, and from a logistic regression on hashed character n-grams."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A verdict on a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | F.endswith(host, F.lit(f".{self.host}"))
        return own & F.startswith(path, F.lit(self.path))


# Names of the kinds of hosts that a crawl leaves out, and of those that it keeps.
UNWANTED_NAMES = """
    bestcasinobonus onlinecasino24 casino-royale-games pokerstarsbonus sportbetting-odds betwinner365
    freebetsdaily lottery-winner-claim jackpotslots roulette-strategy discountviagra cheap-cialis-pharmacy
    pillsonline rxmeds4less weightlosspills buy-cheap-watches replicahandbags payday-loans-now fastcashloan
    crypto-doubler bitcoinprofit make-money-fast earnfreecash freeiphonegiveaway hotadultvideos adult-webcams
    sexcams xxxporntube nude-pics-gallery escortgirls milfdating adserver clicktrack popunder-ads banneradclicks
    linkfarm buy-backlinks-seo spammailer bulk-email-spam free-download-crack warezcrack malwarescan-alert
    virus-removal-now account-verify-login paypal-secure-login free-followers-likes torrentmovies
    essaywriting-cheap
    casinobonus-club megacasino spamhosting spam-pages viagrashop cheapmeds pharmacy-discount betting-tips-pro
    betonline poker-room pornvideos porn-free xxx-movies adult-dating adultfriends seo-traffic
    malwarehost phishing-bank loanshark instant-loans crackedgames replica-shop winprizes moneymaker
""".split()
WANTED_NAMES = """
    cityofhelsinki nature-journal daily-courier jean-luc sport-news wikibooks museum-of-art pythonweekly
    university-press st-marys-school railwaymuseum openlibrary thegardenpages botany weatherservice parliament
    mountainhiking recipes-from-home localhistory cardiffcouncil orchestra-paris theatre-royal stanfordnotes
    thelighthouse nationalpark family-doctor hospital-trust kids-science bookreviews chess-club astronomynow
    travel-notes elperiodico zeitgeschehen lemonde biblioteca oldbridge-brewery cycling-routes open-source-maps
    woodworkers birdwatching northern-lights motherandchild bridgeworks tenniscoach farmers-union sundaypaper
    red-cross
    stadtbibliothek maritime-museum shakespeare-theatre rosegarden cathedral-choir marathon watercolour philharmonic
    geology-survey tidetables bakers-guild oceanography alpine-huts grandparents dutch-painters lighthousekeepers
    earthquake-map translators heritage-trust vegetable-growers covered-bridges northsea-ferries winterolympics threadandneedle
""".split()


def _urls(names: Sequence[str]) -> list[str]:
    """A URL for each name. Both kinds get the same prefixes, domains and paths, so that only names tell them apart."""
    prefixes, domains = ("www.", "", "m.", "blog.", ""), ("com", "net", "org", "example.net", "info", "de", "co.uk", "example.org")
    paths = ("/", "/en/12", "/index.html", "/de/7?page=2", "/2019/archive", "/a/b")
    return [
        f"https://{prefixes[k % 5]}{name}.{domains[k % 8]}{paths[k % 6]}" for k, name in enumerate(names)
    ]


# The small labelled table, 1 for URLs that a crawl should leave out.
LABELLED_URLS = [(url, 1) for url in _urls(UNWANTED_NAMES)] + [(url, 0) for url in _urls(WANTED_NAMES)]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; columns that are already called so are replaced.

    The host goes from the first ``://`` to the next ``/``, ``?``, ``#`` or the
    end, with A-Z in lower case, and the path from there to ``?``, ``#`` or the
    end. Both are empty for NULL and for a text without ``://``.
    """
    whole = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise(F.lit(""))
    parts = r"^([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(rest, parts, 1), _UPPER, _LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, parts, 2)})


def _grams(text: Column, kind: str, sizes: Sequence[int], buckets: int) -> Column:
    """The buckets of all character n-grams of a text with its ends marked."""
    marked = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def grams_of(chars: Column, n: int) -> Column:
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda i: F.pmod(F.xxhash64(F.lit(kind), *[F.get(chars, i + k) for k in range(n)]), F.lit(buckets)),
        )

    def of(chars: Column) -> Column:
        return F.array_distinct(F.flatten(F.array(*[grams_of(chars, n) for n in sizes])))

    # As a lambda variable the characters are split off once and not for every n-gram.
    return F.flatten(F.transform(F.array(marked), of))


def features(pages: DataFrame, sizes: Sequence[int], buckets: int) -> Column:
    """The distinct buckets of a parsed row, those of the host before those of the path."""
    host = _grams(F.col("host"), "host", sizes, buckets)
    path = _grams(F.col("path"), "path", sizes, buckets)
    return F.array_distinct(F.concat(host, path))


@dataclass(frozen=True)
class UrlModel:
    """A weight for every bucket, and the weight that all URLs have."""

    weights: list[float]
    intercept: float
    sizes: tuple[int, ...]

    def score(self, pages: DataFrame) -> Column:
        """How likely a parsed row is to be one to leave out."""
        weights = F.from_json(F.lit(json.dumps(self.weights)), "array<double>")
        found = features(pages, self.sizes, len(self.weights))
        total = F.aggregate(
            found, F.lit(float(self.intercept)), lambda sum_, i: sum_ + F.get(weights, i.cast("int"))
        )
        return 1 / (1 + F.exp(-total))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table, ``url, label``."""
    rows = F.array(*[F.struct(F.lit(url).alias("url"), F.lit(float(label)).alias("label")) for url, label in LABELLED_URLS])
    return spark.range(1, numPartitions=1).select(F.inline(rows))


def train(
    labelled: DataFrame, sizes: tuple[int, ...] = (3, 4, 5), buckets: int = 8192, strength: float = 0.01
) -> UrlModel:
    """Fit a model to a small table ``url, label`` of a few thousand rows at most.

    Rows without a label or a URL do not count. With one class or none there is
    nothing to fit, and the model takes every URL for that class, or lets it pass.
    """
    rows = parsed(labelled.filter("url IS NOT NULL AND label IS NOT NULL"))
    found = features(rows, sizes, buckets)
    # A vocabulary of bucket numbers makes sparse vectors whose places are the buckets.
    numbers = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(buckets)], inputCol="found", outputCol="features"
    )
    vectors = numbers.transform(rows.select("label", found.cast("array<string>").alias("found"))).select("label", "features")
    kinds = [row[0] for row in vectors.select("label").distinct().limit(3).collect()]
    if len(kinds) < 2:
        return UrlModel([0.0] * buckets, 20.0 if kinds == [1.0] else -20.0, tuple(sizes))
    fitted = LogisticRegression(regParam=strength, standardization=False, maxIter=25).fit(vectors.coalesce(1))
    return UrlModel([float(w) for w in fitted.coefficients.toArray()], float(fitted.intercept), tuple(sizes))


def judge(
    pages: DataFrame, rules: Sequence[Rule], model: UrlModel, url: str = "url", threshold: float = 0.7
) -> DataFrame:
    """Add ``host, path, rule, verdict, score`` to every row; columns of these names are replaced.

    The longest rule that fits gives the verdict; of equally long ones the
    first in the list. Where none fits, ``rule`` is NULL and the model decides,
    also on NULL, empty and malformed URLs, which have neither host nor path. Repeated rows are judged alike, and
    an empty table gives none.
    """
    rows = parsed(pages, url)
    rule = F.lit(None).cast("string")
    verdict = F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, r.text).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    scored = rows.withColumn("score", model.score(rows))
    return scored.withColumns({"rule": rule, "verdict": verdict})
