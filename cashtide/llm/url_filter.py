"""URL filter: host and path rules first, a character language-model ratio for the rest.

Two variable-order Markov models, one of accepted and one of rejected addresses, are learned from the
addresses that rules decide.  The probability of a character after up to ``order`` characters is
interpolated over all shorter contexts (Witten-Bell: a context is trusted as far as it has been seen
more often than with new followers).  The score of an address is its log-likelihood ratio per
character; the threshold is calibrated on a fifth of the ruled addresses, which the models do not see.

All counts are DataFrame aggregations over every address.  The longest grams are counted once with
map-side combining; shorter orders are sums of them.  Probabilities are tables keyed by gram.  All joins
are hinted as sort-merge joins, so nothing grows on the driver: without a hint the planner takes the
grams of all addresses to be no larger than the stored addresses, hundreds of times too small, and
broadcasts them.  The driver only sees the calibration histogram, which has a fixed number of bins.

Defined cases: a null address, or one without ``://``, has an empty host and path and no rule and is
scored as it is (null as empty); repeated addresses are scored once and get one verdict; without
ruled addresses of both kinds every score is 0.0 and the verdict is allow; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashtide.sources.workspace import materialize

RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
ORDER = 5
ALPHABET = 65_536  # the chance of a character without any context is one of so many
BEGIN, END = "\x02", "\x03"
BINS, REACH = 2_000, 5.0  # calibration histogram: bins between -REACH and REACH
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null where none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for text, verdict in sorted(rules, key=lambda r: len(r[0])):
        site, slash, rest = text.partition("/")
        fits = (host == site) | F.endswith(host, F.lit("." + site))
        if slash:
            fits = fits & F.startswith(path, F.lit(slash + rest))
        found = F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found).otherwise(chosen)
    return chosen


def _grams(urls: DataFrame, order: int, *kept: str) -> DataFrame:
    """Every character of ``url`` with the ``order`` characters before it."""
    padded = F.concat(F.lit(BEGIN * order), F.col("url"), F.lit(END))
    starts = F.sequence(F.lit(1), F.length(padded) - order)
    grams = F.transform(starts, lambda i: F.substring(padded, i, order + 1))
    return urls.select(F.explode(grams).alias("gram"), *kept)


def gram_counts(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, good, bad): occurrences in accepted and rejected addresses of the learning set."""
    learns = F.col("learns").cast("long")
    rows = urls.select("url", (learns * (F.col("kind") == "allow").cast("long")).alias("good"), (learns * (F.col("kind") == "block").cast("long")).alias("bad"))
    rows = rows.select("url", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))
    return _grams(rows, order, "good", "bad").groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): log of the two smoothed probabilities of the gram's last character."""
    sums = ("good", "bad")
    levels = [counts]
    for _ in range(order):
        shorter = levels[-1].groupBy(F.expr("substring(gram, 2)").alias("gram"))
        levels.append(materialize(shorter.agg(*(F.sum(c).alias(c) for c in sums)), "url-grams"))
    chances = None
    for level in reversed(levels):
        # A context has no more rows than there are characters, so its window is small.
        context = Window.partitionBy(F.expr("substring(gram, 1, length(gram) - 1)"))
        joined = level.withColumns(
            {f"{c}_all": F.sum(c).over(context) for c in sums}
            | {f"{c}_kinds": F.count(F.when(F.col(c) > 0, 1)).over(context) for c in sums}
        )
        if chances is None:
            joined = joined.withColumns({f"{c}_shorter": F.lit(1.0 / ALPHABET) for c in sums})
        else:
            shorter = chances.select(F.col("gram").alias("_gram"), *(F.col(f"{c}_chance").alias(f"{c}_shorter") for c in sums))
            joined = joined.join(shorter.hint("merge"), F.expr("substring(gram, 2)") == F.col("_gram"))
        chance = {}
        for c in sums:
            seen, kinds = F.col(f"{c}_all"), F.col(f"{c}_kinds")
            smoothed = (F.col(c) + kinds * F.col(f"{c}_shorter")) / (seen + kinds)
            chance[f"{c}_chance"] = F.when(seen > 0, smoothed).otherwise(F.col(f"{c}_shorter"))
        chances = joined.withColumns(chance).select("gram", *chance)
    return chances.select("gram", (F.log("good_chance") - F.log("bad_chance")).alias("ratio"))


def scores(urls: DataFrame, ratios: DataFrame, order: int = ORDER) -> DataFrame:
    """(url, score): mean log ratio per character."""
    rows = _grams(urls, order, "url").join(ratios.hint("merge"), "gram")
    return rows.groupBy("url").agg(F.round(F.avg("ratio"), 9).alias("score"))


def calibrate(rows: DataFrame) -> float:
    """The threshold with the least balanced error over (score, kind); 0.0 without both kinds."""
    width = 2 * REACH / BINS
    bin_of = F.floor((F.least(F.greatest(F.col("score"), F.lit(-REACH)), F.lit(REACH)) + REACH) / width)
    table = (
        rows.groupBy(bin_of.alias("bin"))
        .agg(F.count(F.when(F.col("kind") == "allow", 1)).alias("good"), F.count(F.when(F.col("kind") == "block", 1)).alias("bad"))
        .orderBy("bin")
        .collect()
    )
    good, bad = sum(r["good"] for r in table), sum(r["bad"] for r in table)
    if not good or not bad:
        return 0.0
    best, at, lost, kept = 1.0, 0.0, 0, bad
    for low, row in [(None, None), *((r["bin"], r) for r in table)]:
        if row is not None:
            lost, kept = lost + row["good"], kept - row["bad"]
        error = lost / good + kept / bad
        if error < best:
            # Everything up to this bin is rejected: the threshold is its upper edge.
            best, at = error, -REACH + width * ((low if low is not None else -1) + 1)
    return at


def judged(pages: DataFrame, rules: list[tuple[str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row."""
    url = F.col("url")
    rows = pages.select("page_id", F.coalesce(url, F.lit("")).alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "url", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("kind"))
    calibrates = F.crc32(F.col("url").cast("binary")) % 5 == 0
    urls = rows.groupBy("url").agg(F.max("kind").alias("kind")).withColumn("learns", ~calibrates)
    # Two full passes over the distinct addresses, one to learn and one to score: stored once.
    urls = materialize(urls, "urls")
    counts = materialize(gram_counts(urls, order), "url-grams")
    ratios = materialize(log_ratios(counts, order), "url-ratios")
    scored = materialize(scores(urls, ratios, order).join(urls.hint("merge"), "url"), "url-scores")
    both = urls.where("learns").agg(F.count_distinct("kind")).first()[0] == 2
    threshold = calibrate(scored.where("not learns and kind is not null")) if both else 0.0
    verdicts = scored.select("url", (F.col("score") if both else F.lit(0.0)).alias("score"))
    verdict = F.coalesce("kind", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return rows.join(verdicts.hint("merge"), "url").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
