"""URL filter: rules by host and path, and for the rest the ratio of two character language models.

URLs that a rule allows or blocks train one smoothed variable-order Markov model each: the probability of a character
interpolates those of all context lengths up to four, each weighted by how often its context was followed by something new
(Witten-Bell). A URL's verdict is its log-likelihood difference divided by its length, against a threshold calibrated on the
URLs that the rules decide.

Native: DataFrame functions only. Equal texts are scored once, however many pages have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultgauge.llm.shared import shared_folder, written

#: The rules, host and path, and whether they allow.
RULES = [("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False)]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest context, in characters.
ORDER = 4
#: Characters that the models can tell apart, for the share of a character never seen.
ALPHABET = 256
#: Steps between the lowest and the highest score at which the threshold is sought.
STEPS = 200


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, with A-Z in lower case; empty for null or without '://'."""
    rest = F.substr(url, F.locate("://", url) + 3)
    return F.when(F.locate("://", url) > 0, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end."""
    rest = F.substr(url, F.locate("://", url) + 3)
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, bool]]) -> Column:
    """The longest rule that fits, as a struct of its text and whether it allows; null if none does."""
    fits = lambda h, p: ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
    by_length = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    value = lambda h, p, allow: F.struct(F.lit(h + p).alias("text"), F.lit(allow).alias("allow"))
    return F.coalesce(*[F.when(fits(h, p), value(h, p, allow)) for h, p, allow in by_length])


def _grams(urls: DataFrame) -> DataFrame:
    """One row per distinct URL and character: the character with the four before it; '\\u0002' pads the beginning, '\\u0003' ends it."""
    text = F.concat(F.lit("\u0002" * ORDER), F.col("url"), F.lit("\u0003"))
    # characters as an array of their own column: a place in a string is found by counting from its beginning
    at = F.transform(F.sequence(F.lit(1), F.size("letters") - ORDER), lambda i: F.concat_ws("", F.slice("letters", i, ORDER + 1)))
    return urls.withColumn("letters", F.split(text, "")).select("url_key", "weight", "allow", F.explode(at).alias("gram"))


def _model(grams: DataFrame) -> DataFrame:
    """gram, ratio: log-probability of its last character after the others by the accepting model less that by the rejecting one."""
    known = grams.where(F.col("allow").isNotNull()).groupBy("gram").agg(
        *[F.sum(F.when(F.col("allow") == a, F.col("weight")).otherwise(0)).alias(n) for a, n in ((True, "yes"), (False, "no"))]
    )
    wanted = grams.select("gram").distinct()
    chance = {n: F.lit(1.0 / ALPHABET) for n in ("yes", "no")}
    for order in range(ORDER + 1):
        suffix = F.right(F.col("gram"), F.lit(order + 1))
        counts = known.groupBy(suffix.alias("suffix")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        context = F.left("suffix", F.lit(order))
        totals = counts.groupBy(context.alias("context")).agg(
            *[F.sum(n).alias(f"{n}_all") for n in ("yes", "no")], *[F.count(F.when(F.col(n) > 0, 1)).alias(f"{n}_kinds") for n in ("yes", "no")]
        )
        wanted = (
            wanted.withColumns({"suffix": suffix, "context": F.left(suffix, F.lit(order))})
            .join(counts.withColumnsRenamed({"yes": "yes_n", "no": "no_n"}), "suffix", "left")
            .join(totals, "context", "left")
        )
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
        smoothed = {n: F.when(zero(f"{n}_all") > 0, (zero(f"{n}_n") + zero(f"{n}_kinds") * chance[n]) / (zero(f"{n}_all") + zero(f"{n}_kinds"))).otherwise(chance[n]) for n in chance}
        wanted = wanted.select("gram", smoothed["yes"].alias("p_yes"), smoothed["no"].alias("p_no"))
        chance = {"yes": F.col("p_yes"), "no": F.col("p_no")}
    return wanted.select("gram", (F.log("p_yes") - F.log("p_no")).alias("ratio"))


def _threshold(scored: DataFrame) -> Column:
    """The score at which the shares of allowed URLs kept and of blocked URLs refused add up to most: one row, at most STEPS counts a side."""
    known = scored.where(F.col("allow").isNotNull())
    bounds = known.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    if bounds["low"] is None:
        return F.lit(0.0)
    width = (bounds["high"] - bounds["low"]) / STEPS or 1.0
    step = F.least(F.floor((F.col("score") - bounds["low"]) / width), F.lit(STEPS - 1)).alias("step")
    counts = known.groupBy(step).agg(
        *[F.sum(F.when(F.col("allow") == a, F.col("weight")).otherwise(0)).alias(n) for a, n in ((True, "yes"), (False, "no"))]
    ).orderBy("step").collect()
    all_yes, all_no = (max(1, sum(r[n] for r in counts)) for n in ("yes", "no"))
    best, at, yes, no = -1.0, bounds["low"], all_yes, 0
    for r in counts:
        gain = yes / all_yes + no / all_no
        if gain > best:
            best, at = gain, bounds["low"] + r["step"] * width
        yes, no = yes - r["yes"], no + r["no"]
    return F.lit(float(at))


def judged(pages: DataFrame, rules: list[tuple[str, str, bool]] = RULES) -> DataFrame:
    """One row per row of pages: page_id, url, host, path, rule, verdict, score.

    A rule fits its host and all subdomains, if the path starts with the rule's; the longest decides. For the others the
    verdict is allow from the calibrated threshold on, else block. A null or empty URL has no text: its score is 0. Rules of one kind
    only, or no decided URL, leave every other score at 0 or at the one model's ratio; nothing is dropped.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("fits", rule_of(F.col("host"), F.col("path"), rules))
    urls = rows.where(F.length("url") > 0).groupBy("url").agg(F.count("*").alias("weight"), F.first("fits.allow").alias("allow"))
    urls = urls.withColumn("url_key", F.md5("url"))  # a long URL isn't repeated for each of its characters
    folder = shared_folder(pages.sparkSession, "url-filter")
    urls = written(urls, f"{folder}/urls")
    grams = _grams(urls)
    model = written(_model(grams), f"{folder}/model")
    # a gram that many URLs share meets its one row of the model: only the URLs' side is large, and that side can be split
    scored = grams.join(model, "gram").groupBy("url_key", "weight", "allow").agg((F.sum("ratio") / F.count("*")).alias("score"))
    scored = written(scored, f"{folder}/scored")
    threshold = _threshold(scored)
    found = rows.join(scored.select("url_key", "score"), F.md5("url") == F.col("url_key"), "left")
    score = F.coalesce("score", F.lit(0.0))
    allow = F.coalesce("fits.allow", score >= threshold)
    return found.select(
        "page_id", "url", "host", "path", F.col("fits.text").alias("rule"), F.when(allow, "allow").otherwise("block").alias("verdict"), score.alias("score")
    )
