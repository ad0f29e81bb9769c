"""URL filter: host and path rules, and gradient-boosted trees on lexical features for URLs without a rule.

Only DataFrame functions see the data. The trees are fitted on a bounded sample and become one column expression.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilnote.llm.boosting import Boosted, fit

# Fixed values: (verdict, host, path) of the rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

# Syllables of made-up words, letters of drawn strings and host endings, for the labelled URLs.
SYLLABLES = ("ba", "ke", "li", "mo", "nu", "ra", "sel", "tor", "vin", "dan", "fer", "gos", "hul", "pim", "wex", "yol", "zar", "cor", "jen", "qua")
CHARACTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
LABEL_ENDINGS = ("com", "net", "org", "info", "co.uk", "com.au", "xyz.io", "web.top", "site.biz", "edu", "gov.uk", "de")

#: Labelled URLs that are made; labelled URLs to fit on, at most; host endings whose share of blocked URLs is a feature,
#: and labelled URLs that such an ending of two labels must have.
LABELLED, SAMPLE, ENDINGS, LEAST_SEEN = 12_000, 20_000, 400, 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest rule that fits, or null. A rule fits its host and all subdomains,
    if the path starts with the rule's."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ordered]
    name = F.coalesce(*(F.when(fit_, F.lit(h + p)) for fit_, (_, h, p) in zip(fits, ordered, strict=True)))
    verdict = F.coalesce(*(F.when(fit_, F.lit(v)) for fit_, (v, _, _) in zip(fits, ordered, strict=True)))
    return name, verdict


FEATURES = ("url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio", "hyphens",
            "entropy", "parameters", "longest_label", "secure", "fragment", "percent", "ending_share")


def entropy(text: Column) -> Column:
    """Bits a character, by the counts of the different characters."""
    letters = F.split(text, "")
    size = F.greatest(F.size(letters), F.lit(1)).cast("double")
    counts = F.transform(F.array_distinct(letters), lambda x: F.size(F.filter(letters, lambda y: y == x)) / size)
    return F.aggregate(counts, F.lit(0.0), lambda s, p: s - p * F.log2(p))


def ending(host: Column, labels: int) -> Column:
    """The last labels of the host, or all if it has fewer."""
    return F.substring_index(host, ".", -labels)


def feature_columns(shares: dict[str, float], usual: float) -> list[Column]:
    """FEATURES of url, host and path; shares are the smoothed shares of blocked URLs by host ending. The last two labels
    count if they are known, else the last one."""
    url, host, path = F.coalesce(F.col("url").cast("string"), F.lit("")), F.col("host"), F.col("path")

    def count(text: Column, pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    known = F.create_map(*(F.lit(x) for pair in sorted(shares.items()) for x in pair)) if shares else None
    share = F.coalesce(known[ending(host, 2)], known[ending(host, 1)], F.lit(usual)) if known is not None else F.lit(usual)
    labels = F.transform(F.split(host, r"\."), lambda x: F.length(x))
    return [F.length(url).cast("double"), F.length(host).cast("double"), F.length(path).cast("double"), count(host, r"\."), count(path, "/"),
            count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)), count(host, "[0-9]") / F.greatest(F.length(host), F.lit(1)),
            count(host, "-"), entropy(host), count(url, "[?&][^=&#]+="), F.array_max(labels).cast("double"),
            url.startswith("https").cast("double"), url.contains("#").cast("double"), count(url, "%"), share]


@dataclass
class UrlModel:
    trees: Boosted
    shares: dict[str, float]
    usual: float

    def chance(self) -> Column:
        """Chance that a row of url, host and path is to be blocked."""
        return 1 / (1 + F.exp(-self.trees.column([F.col(f"f{k}_") for k in range(len(FEATURES))])))

    def measured(self, urls: DataFrame) -> DataFrame:
        return urls.withColumns({f"f{k}_": c for k, c in enumerate(feature_columns(self.shares, self.usual))})


def train(labelled: DataFrame, sample: int = SAMPLE) -> UrlModel:
    """From labelled(url, host, path, blocked 0/1): the rows with the smallest hashes, at most `sample`. The shares by
    ending come from one half of them and the trees from the other, so that trees see shares as on new URLs."""
    chosen = labelled.where(F.col("blocked").isin(0, 1) & F.col("url").isNotNull()).select("url", "host", "path", "blocked").distinct().orderBy(
        F.xxhash64("url"), "url", "blocked").limit(sample).withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "url"), F.lit(2)))
    fitted = chosen.where("half = 0")
    total = fitted.agg(F.count("*").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked")).first()
    usual = (total.blocked + 1) / (total.n + 2)
    both = F.explode(F.array_distinct(F.array(ending(F.col("host"), 1), ending(F.col("host"), 2))))
    first = fitted.select("blocked", both.alias("ending")).groupBy("ending").agg(F.sum("blocked").alias("blocked"), F.count("*").alias("n")).where(
        ~F.col("ending").contains(".") | (F.col("n") >= LEAST_SEEN)).orderBy(F.desc("n"), "ending").limit(ENDINGS).collect()
    model = UrlModel(Boosted(0.0, []), {r.ending: (r.blocked + 4 * usual) / (r.n + 4) for r in first}, usual)
    rows = model.measured(chosen.where("half = 1")).orderBy(F.xxhash64("url"), "url", "blocked").collect()
    x = np.array([[r[f"f{k}_"] for k in range(len(FEATURES))] for r in rows], float).reshape(-1, len(FEATURES))
    model.trees = fit(x, np.array([r.blocked for r in rows], float), trees=30, depth=3)
    return model


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked): LABELLED made-up URLs, half of them to be blocked. Both kinds draw from the same syllables, endings
    and forms; hyphens, numbers, random strings, subdomains, depth, parameters and endings are only more frequent in one
    of them, so no sign decides by itself and only several together do."""
    def chance(salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1_000_000)) / 1_000_000

    def often(salt: int, bad: float, good: float) -> Column:
        """Whether a sign is there: with one chance if the URL is to be blocked, else with the other."""
        return chance(salt) < F.when(F.col("blocked") == 1, bad).otherwise(good)

    def one_of(choices: tuple[str, ...], salt: int) -> Column:
        return F.element_at(F.array(*map(F.lit, choices)), F.floor(chance(salt) * len(choices)).cast("int") + 1)

    def number(salt: int, least: int, most: int) -> Column:
        return (F.floor(chance(salt) * (most - least)) + least).cast("string")

    def word(salt: int) -> Column:
        return F.concat(one_of(SYLLABLES, salt), one_of(SYLLABLES, salt + 1), F.when(chance(salt + 2) < 0.5, one_of(SYLLABLES, salt + 3)).otherwise(""))

    def letters(salt: int, size: int) -> Column:
        return F.concat(*(one_of(tuple(CHARACTERS), salt + k) for k in range(size)))

    def where(sign: Column, text: Column | str) -> Column:
        return F.when(sign, text).otherwise("")

    half = len(LABEL_ENDINGS) // 2
    last = F.when(often(1, 0.25, 0.8), one_of(LABEL_ENDINGS[:half], 2)).otherwise(one_of(LABEL_ENDINGS[half:], 2))
    host = F.concat(
        where(often(10, 0.35, 0.6), one_of(("www.", "m.", "blog."), 11)), where(often(12, 0.5, 0.12), F.concat(word(13), F.lit("."))),
        where(often(20, 0.5, 0.06), F.concat(letters(21, 5), F.lit("."))), word(30), where(often(34, 0.6, 0.3), F.lit("-")), word(40),
        where(often(50, 0.55, 0.1), number(51, 1, 1000)), where(often(52, 0.4, 0.1), letters(53, 6)), F.lit("."), last)
    parts = F.concat(F.lit("/"), where(often(60, 0.75, 0.75), F.concat(word(61), F.lit("/"))), where(often(65, 0.55, 0.25), F.concat(word(66), F.lit("/"))),
                     where(often(70, 0.6, 0.12), F.concat(letters(71, 8), F.lit("/"))), where(often(80, 0.6, 0.5), number(81, 1, 100_000)))
    after = F.concat(where(often(90, 0.15, 0.35), F.lit(".html")), where(often(91, 0.6, 0.3), F.concat(F.lit("?page="), number(92, 1, 50))),
                     where(often(91, 0.5, 0.08), F.concat(F.lit("&ref="), word(93), F.lit("&c="), letters(97, 6))), where(often(104, 0.1, 0.25), F.lit("#top")))
    made = spark.range(LABELLED).withColumn("blocked", F.pmod("id", F.lit(2)).cast("int"))
    return made.select(F.concat(F.when(often(105, 0.3, 0.75), "https://").otherwise("http://"), host, parts, after).alias("url"), "blocked")


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, chance) of each row of pages(page_id, url).

    The verdict is the longest fitting rule's; without one it is block if the trees see a chance of half or more. The
    trees are trained from labelled(url, blocked), by default labelled_urls(). (URLs that a rule decides would teach
    them the rules' hosts.) Null or odd URLs have an
    empty host and path and fit no rule; null and repeated ids are rows like any other; extra columns are ignored.
    """
    url = F.col("url").cast("string")
    split = pages.select("page_id", url.alias("url")).withColumns({"host": host_of(url), "path": path_of(url)})
    name, verdict = best_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": name, "verdict_": verdict})
    known = labelled_urls(pages.sparkSession) if labelled is None else labelled
    model = train(known.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}))
    return model.measured(ruled).withColumn("chance", model.chance()).select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict_", F.when(F.col("chance") >= 0.5, "block").otherwise("allow")).alias("verdict"), "chance")
