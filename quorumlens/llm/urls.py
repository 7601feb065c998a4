"""URL filter: rules first, then a ratio of character models.

Rules name a host and the beginning of a path; they fit the host and its subdomains, and the longest one decides.  The
urls that rules decide teach two variable-order Markov models of characters, one of accepted and one of rejected
urls.  A character's probability after its last ORDER characters is smoothed down the orders: counts at one order are
mixed with the next shorter context, weighted by SMOOTH; below order 0 all characters are equally likely.  A url's
score is the logarithm of the ratio of its probabilities under the two models, divided by its length.  Two thirds of
the urls that rules decide count into the models, the rest calibrate the threshold: the one with the fewest errors,
both classes weighing the same.  Urls below the threshold are blocked.

All of it is DataFrame work: counts are aggregates over (class, context, character), probabilities are joins of each
order to the next, and positions of urls are joined to one table of distinct windows.

Edge cases: host and path are empty for a null url or one without ``://``; no rule fits them, and their text is empty
and scores 0; without urls of both classes, or with nothing to calibrate on, the threshold is 0; scores are rounded
to six places, and a score at the threshold is allowed; repeated rows are judged alike and each counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quorumlens.llm.common import BROADCAST_ROWS, counted_broadcast, settled

#: Characters of context, weight of the shorter context, characters that a url may hold.
ORDER, SMOOTH, ALPHABET = 4, 2.0, 256
#: Of so many folds one calibrates.
FOLDS = 3
#: Stands before the first character.
START = "\x02"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: what stands between ``://`` and the next of ``/?#``, and from there to ``?#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``urls`` (with host, path) with ``rule`` and ``by_rule``; rules are (verdict, host, path), the longest wins."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, host, path in reversed(ordered):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("by_rule", verdict)


def _windows(texts: DataFrame) -> DataFrame:
    """One row per character of ``text``: ``gram``, the ORDER characters before it and itself."""
    padded = F.concat(F.lit(START * ORDER), F.col("text"))
    return (
        texts.where(F.length("text") > 0)
        .withColumn("padded", padded)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.length("text"))))
        .withColumn("gram", F.expr(f"substring(padded, at, {ORDER + 1})"))
        .drop("padded", "at", "text")
    )


def model(training: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, ratio) for all ``grams``: log of accepted over rejected probability of the last character.

    ``training`` has ``text``, ``accepted`` and ``n`` (rows with that text); ``grams`` the windows that occur.
    """
    times = lambda accepted: F.sum(F.when(F.col("accepted") == accepted, F.col("n")).otherwise(0))
    seen = settled(
        _windows(training.select("text", "accepted", "n"))
        .groupBy("gram")
        .agg(times(True).alias("yes"), times(False).alias("no")),
        "url-grams",
    )
    found = grams.select("gram").withColumn("pyes", F.lit(1.0 / ALPHABET)).withColumn("pno", F.lit(1.0 / ALPHABET))
    for order in range(ORDER + 1):
        # Counts of the last `order` characters of context, with and without the character itself.
        tail = seen.select(F.expr(f"substring(gram, {ORDER + 1 - order}, {order + 1})").alias("tail"), "yes", "no")
        joint = tail.groupBy("tail").agg(F.sum("yes").alias("jy"), F.sum("no").alias("jn"))
        context = tail.groupBy(F.expr(f"substring(tail, 1, {order})").alias("context")).agg(
            F.sum("yes").alias("cy"), F.sum("no").alias("cn")
        )
        found = found.withColumn("tail", F.expr(f"substring(gram, {ORDER + 1 - order}, {order + 1})"))
        found = found.withColumn("context", F.expr(f"substring(tail, 1, {order})"))
        found = found.join(joint, "tail", "left").join(context, "context", "left")

        def mix(joint_n: str, context_n: str, below: str) -> Column:
            n, c = (F.coalesce(F.col(x), F.lit(0)) for x in (joint_n, context_n))
            return (n + SMOOTH * F.col(below)) / (c + SMOOTH)

        found = found.select("gram", mix("jy", "cy", "pyes").alias("pyes"), mix("jn", "cn", "pno").alias("pno"))
    return found.select("gram", (F.log("pyes") - F.log("pno")).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score, on a grid of 0.001, below which blocking makes the fewest errors among ``scored`` (score, accepted,
    n), both classes weighing the same; the least of equals, and 0 without both classes."""
    times = lambda accepted: F.sum(F.when(F.col("accepted") == accepted, F.col("n")).otherwise(0))
    # Scores are bounded, so the grid has a bounded number of rows whatever the number of urls.
    grid = scored.groupBy(F.floor(F.col("score") * 1000).alias("step")).agg(
        times(True).alias("yes"), times(False).alias("no")
    )
    grid = settled(grid, "url-grid")
    yes, no = grid.agg(F.sum("yes"), F.sum("no")).first()
    if not yes or not no:
        return 0.0
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    lost = F.coalesce(F.sum("yes").over(below), F.lit(0)) / F.lit(float(yes))
    missed = 1 - F.coalesce(F.sum("no").over(below), F.lit(0)) / F.lit(float(no))
    return grid.select(F.round(lost + missed, 9).alias("wrong"), "step").agg(F.min(F.struct("wrong", "step"))).first()[0][1] / 1000


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per row of ``pages``; verdicts are allow and block."""
    host, path = parts(F.col(url_col))
    rows = ruled(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")), rules)
    # Rows with one host and path share all that follows; a third of all rows may.
    texts = rows.groupBy("host", "path", "by_rule").agg(F.count("*").alias("n")).withColumn("text", F.concat("host", "path"))
    fold = F.pmod(F.instr(F.lit("0123456789abcdef"), F.substring(F.md5("text"), 1, 1)), F.lit(FOLDS))
    texts = settled(texts.withColumn("fold", fold).withColumn("accepted", F.col("by_rule") == "allow"), "url-texts")
    windows = _windows(texts.select("host", "path", "text"))
    grams = settled(windows.select("gram").distinct(), "url-windows")
    ratios = settled(model(texts.where("by_rule is not null and fold != 0"), grams), "url-ratios")
    sums = windows.join(counted_broadcast(ratios, 10 * BROADCAST_ROWS), "gram").groupBy("host", "path")
    means = sums.agg(F.round(F.sum("ratio") / F.count("*"), 6).alias("score"))
    scored = texts.join(means, ["host", "path"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    scored = settled(scored, "url-scores")
    cut = threshold(scored.where("by_rule is not null and fold = 0"))
    verdict = F.coalesce("by_rule", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    judged = scored.select("host", "path", "score", verdict.alias("verdict"))
    return rows.select("page_id", "host", "path", "rule").join(judged, ["host", "path"])
