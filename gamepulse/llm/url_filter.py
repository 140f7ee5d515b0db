"""URL filter: host and path rules first, a character language-model ratio for the rest.

DataFrame functions only. Two variable-order Markov models over URL characters are learnt from the
URLs that rules accept and reject; Witten-Bell smoothing mixes all orders down to a uniform one.
A URL without rule is allowed if its length-normalised log-likelihood difference reaches a
threshold that is calibrated on rule-judged URLs held out of the training.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import ascii_lower, two_hashes


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


SALTS = 64
PAD, STOP = "\u0002", "\u0003"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule], what: str) -> Column:
    """Verdict or name of the longest fitting rule, else null; the earlier one wins a tie."""
    out = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.verdict if what == "verdict" else r.host + r.path)).otherwise(out)
    return out


def left_out(url: str, one_in: int) -> Column:
    """Whether a URL is left out of the training: by its md5, as any engine can tell."""
    return F.conv(F.substring(F.md5(url), 1, 4), 16, 10).cast("int") % one_in == 0


def _grams(urls: DataFrame, order: int, keep: list[str]) -> DataFrame:
    """One row per character of a URL (with an end sign): the character behind `order` before it.

    The characters are cut once, so a URL costs time in proportion to its length, and rows carry `keep` only.
    """
    chars = F.regexp_extract_all(F.concat(F.lit(PAD * order), "u", F.lit(STOP)), F.lit("(?s)."), F.lit(0))
    cut = urls.select(*keep, chars.alias("chars"))
    grams = F.transform(F.sequence(F.lit(1), F.size("chars") - order), lambda i: F.array_join(F.slice("chars", i, F.lit(order + 1)), ""))
    return cut.select(*keep, F.explode(grams).alias("gram"))


def model_ratios(train: DataFrame, wanted: DataFrame, order: int, alphabet: int = 256) -> DataFrame:
    """(gram, ratio): log10 of the accepted over the rejected probability of every wanted gram.

    `train` has gram, good, n. For a context seen n times before t different characters,
    P(x) = (count(x) + t * P_shorter(x)) / (n + t); an unseen context passes on the shorter one. The contexts of no
    and one character, which all grams share, are met in SALTS copies.
    """
    suffixes = F.explode(F.expr(f"transform(sequence(0, {order}), k -> struct(k AS k, right(gram, k + 1) AS s))"))
    cut = lambda df, *more: df.select("gram", *more, suffixes.alias("x")).select(
        "gram", *more, "x.k", "x.s", F.expr("left(x.s, x.k)").alias("c"))
    good = lambda c: F.sum(F.when(F.col("good"), F.col(c)).otherwise(0))
    bad = lambda c: F.sum(F.when(~F.col("good"), F.col(c)).otherwise(0))
    counts = cut(train, "good", "n").groupBy("k", "s", "c").agg(good("n").alias("ng"), bad("n").alias("nb"))
    contexts = counts.groupBy("k", "c").agg(
        F.sum("ng").alias("cg"), F.sum("nb").alias("cb"),
        F.count_if(F.col("ng") > 0).alias("tg"), F.count_if(F.col("nb") > 0).alias("tb"))
    short = F.col("k") < 2
    salt = F.when(short, F.pmod(F.xxhash64("gram"), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint")).alias("salt")
    copies = F.explode(F.when(short, F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))).alias("salt")
    steps = (
        cut(wanted).join(counts.drop("c"), ["k", "s"], "left").select("*", salt).join(contexts.select("*", copies), ["k", "c", "salt"], "left")
        .groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("k", "ng", "nb", "cg", "cb", "tg", "tb"))).alias("steps"))
    )

    def mixed(p: Column, n: Column, c: Column, t: Column) -> Column:
        n, c, t = (F.coalesce(x, F.lit(0)).cast("double") for x in (n, c, t))
        return F.when(c > 0, (n + t * p) / (c + t)).otherwise(p)

    return steps.select("gram", F.aggregate(
        "steps", F.struct(F.lit(1.0 / alphabet).alias("g"), F.lit(1.0 / alphabet).alias("b")),
        lambda p, s: F.struct(
            mixed(p["g"], s["ng"], s["cg"], s["tg"]).alias("g"), mixed(p["b"], s["nb"], s["cb"], s["tb"]).alias("b")),
        lambda p: F.log10(p["g"]) - F.log10(p["b"])).alias("ratio"))


def filter_urls(
    pages: DataFrame, rules: list[Rule], order: int = 4, holdout: int = 5, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Per row: id, url, host, path, rule, verdict, score (null where a rule decides).

    Distinct URLs (told apart by 128 hashed bits) are learnt from and scored once, in time linear in their length. One of `holdout` rule-judged URLs, by hash, is
    left out of the models; the threshold lies between the mean ratios of held-out accepted and
    rejected URLs, nearer to the one that spreads less. With one kind only, the threshold is 0; with
    no rule-judged URL every ratio is 0 and the URL is allowed. A null URL has an empty host and path
    and is judged as an empty text. Null ids, repeated rows and other columns change nothing:
    every input row gives one output row.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path}).withColumns({
        "rule": matched_rule(F.col("host"), F.col("path"), rules, "name"),
        "judged": matched_rule(F.col("host"), F.col("path"), rules, "verdict"), "u": F.lower(F.coalesce("url", F.lit("")))})
    rows = rows.withColumn("key", two_hashes(F.col("u")))
    urls = rows.groupBy("key", "u").agg(F.max(F.col("judged") == "allow").alias("good"), F.max(F.col("rule").isNull()).alias("open"))
    urls = urls.withColumn("held", F.col("good").isNotNull() & (left_out("u", holdout)))
    train = _grams(urls.filter(F.col("good").isNotNull() & ~F.col("held")), order, ["good"]).groupBy("gram", "good").agg(F.count("*").alias("n"))
    scored = urls.filter(F.col("open") | F.col("held"))
    grams = _grams(scored, order, ["key"]).groupBy("key", "gram").agg(F.count("*").alias("times"))
    ratios = model_ratios(train, grams.select("gram").distinct(), order)
    means = grams.join(ratios, "gram").groupBy("key").agg((F.sum(F.col("ratio") * F.col("times")) / F.sum("times")).alias("score"))
    scores = scored.select("key", "good", "held", "open").join(means, "key")
    held = F.col("held")
    cut = scores.agg(
        F.avg(F.when(held & F.col("good"), F.col("score"))).alias("mg"), F.avg(F.when(held & ~F.col("good"), F.col("score"))).alias("mb"),
        F.stddev_pop(F.when(held & F.col("good"), F.col("score"))).alias("sg"), F.stddev_pop(F.when(held & ~F.col("good"), F.col("score"))).alias("sb"),
    ).select(F.coalesce(
        F.when(F.col("sg") + F.col("sb") > 0, (F.col("mg") * F.col("sb") + F.col("mb") * F.col("sg")) / (F.col("sg") + F.col("sb")))
        .otherwise((F.col("mg") + F.col("mb")) / 2), F.lit(0.0)).alias("threshold"))
    judged = scores.filter("open").select("key", "score", (F.col("score") >= cut.scalar()).alias("pass"))
    free = rows.filter(F.col("rule").isNull()).join(judged, "key").select(
        "id", "url", "host", "path", "rule", F.when(F.col("pass"), "allow").otherwise("block").alias("verdict"), "score")
    ruled = rows.filter(F.col("rule").isNotNull()).select(
        "id", "url", "host", "path", "rule", F.col("judged").alias("verdict"), F.lit(None).cast("double").alias("score"))
    return ruled.union(free).withColumnRenamed("id", id_col)
