"""URL verdicts: rules first, then the ratio of two character language models.

The models learn from URLs that a rule allows or blocks. Each is a variable-order Markov model of
characters with Witten-Bell smoothing: an order's estimate leans on the order below it by the
number of different characters seen after the context. The score of a URL is the mean log ratio
per character; the cut is calibrated on decided URLs that were held out. All steps are built-in
DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadlens.llm.scratch import stored

#: (verdict, host, path): a rule fits its host and all subdomains, if the path starts with the rule's.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
#: Marks before the first and behind the last character, from the private-use area.
START, END = "\ue000", "\ue001"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def _longest(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value) -> Column:
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        out = F.when(_fits(host, path, rule[1], rule[2]), value(rule)).otherwise(out)
    return out


def parse(urls: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """``row`` (a struct of all columns), ``text`` (null: empty), host, path, rule (null where none fits) and its verdict ``ruled``."""
    url = F.col(url_col).cast("string")
    held = urls.select(F.struct("*").alias("row"), F.coalesce(url, F.lit("")).alias("text"), host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    return held.withColumn("rule", _longest(host, path, rules, lambda r: r[1] + r[2])).withColumn(
        "ruled", _longest(host, path, rules, lambda r: r[0])
    )


def grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per character of ``text`` and one for its end: ``gram``, the character behind its ``order`` - 1 predecessors."""
    padded = F.concat(F.lit(START * (order - 1)), F.col("text"), F.lit(END))
    # characters are split once: repeated substr() would search a multi-byte text from its front each time
    chars = F.split(padded, "")
    pieces = F.arrays_zip(*[F.slice(chars, k + 1, F.greatest(F.size(chars) - (order - 1), F.lit(0))).alias(f"c{k}") for k in range(order)])
    one = F.concat(*[F.col("g")[f"c{k}"] for k in range(order)])
    return texts.withColumn("g", F.explode(pieces)).withColumn("gram", one).drop("g", "text")


def log_ratios(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio) from (gram, allow, block), the counts of every gram that is to be scored: log P(last character
    of the gram | the others) under the accepted minus that under the rejected model."""
    base = counted
    level = None
    for k in range(1, order + 1):
        own = base.groupBy(F.substring("gram", order - k + 1, k).alias("gram")).agg(
            F.sum("allow").alias("allow"), F.sum("block").alias("block")
        )
        context = Window.partitionBy(F.substring("gram", 1, k - 1))
        seen = own.select(
            "gram", "allow", "block",
            *[f(F.sum(x).over(context)).alias(f"{n}_{c}") for c in ("allow", "block") for n, f, x in (
                ("n", lambda v: v, F.col(c)), ("t", lambda v: v, (F.col(c) > 0).cast("long")))],
            F.count("*").over(context).alias("width"),
        )
        if level is None:  # below the single characters: all that occur are alike
            seen = seen.withColumn("low_allow", 1.0 / F.col("width")).withColumn("low_block", 1.0 / F.col("width"))
        else:
            below = level.select(F.col("gram").alias("tail"), F.col("p_allow").alias("low_allow"), F.col("p_block").alias("low_block"))
            seen = seen.withColumn("tail", F.substring("gram", 2, k - 1)).join(below, "tail")
        level = seen.select("gram", *[
            F.when(F.col(f"n_{c}") > 0, (F.col(c) + F.col(f"t_{c}") * F.col(f"low_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}")))
            .otherwise(F.col(f"low_{c}")).alias(f"p_{c}") for c in ("allow", "block")
        ])
    return level.select("gram", (F.ln("p_allow") - F.ln("p_block")).alias("ratio"))


def held_out(text: Column) -> Column:
    """Three of sixteen texts, by the first digit of their MD5."""
    return F.substring(F.md5(text.cast("binary")), 1, 1).isin("0", "1", "2")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, order: int = ORDER, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (mean log ratio per character, six decimals; columns of these names are replaced).

    The rule decides where one fits, else the score: allow from the calibrated cut on. The cut lies between
    the mean scores of held-out allowed and blocked URLs, nearer to the one that scatters less; it is 0 if one of
    them has none, and all scores are 0 if either model has no URL. A null URL counts as empty. Equal URLs are learnt
    from once and judged alike; an empty table gives no rows.
    """
    parsed = parse(pages, rules, url_col)
    texts = stored(
        parsed.groupBy("text").agg(F.first("ruled").alias("ruled")).select(
            "text", F.xxhash64("text").alias("id"), "ruled", held_out(F.col("text")).alias("held")
        ), "urls",
    )
    rows = grams(texts, order)
    learnt = lambda verdict: F.when((F.col("ruled") == verdict) & ~F.col("held"), 1).otherwise(0)
    counted = stored(
        rows.groupBy("gram").agg(F.sum(learnt("allow")).alias("allow"), F.sum(learnt("block")).alias("block")), "grams"
    )
    ratios = stored(log_ratios(counted, order), "ratios")
    scores = stored(
        # as a sort-merge join: the size of the exploded rows is guessed far too low, and they must not be broadcast
        rows.hint("merge").join(ratios, "gram").groupBy("id").agg(F.avg("ratio").alias("score"))
        .join(texts.select("id", "text", "ruled", "held"), "id").select("text", "ruled", "held", F.round("score", 6).alias("score")),
        "scores",
    )
    sizes = {r["ruled"]: r for r in scores.where("ruled is not null").groupBy("ruled").agg(
        F.sum(F.when(F.col("held"), 0).otherwise(1)).alias("learnt"), F.count(F.when(F.col("held"), 1)).alias("n"),
        F.avg(F.when(F.col("held"), F.col("score"))).alias("mean"), F.stddev_pop(F.when(F.col("held"), F.col("score"))).alias("spread"),
    ).collect()}  # two rows
    allow, block = sizes.get("allow"), sizes.get("block")
    cut = 0.0
    known = bool(allow and block and allow["learnt"] and block["learnt"])
    if known and allow["n"] and block["n"]:
        a, b = max(allow["spread"], 1e-6), max(block["spread"], 1e-6)
        cut = (allow["mean"] * b + block["mean"] * a) / (a + b)
    score = F.col("score") if known else F.lit(0.0)
    named = parsed.join(scores.select("text", score.alias("score")), "text")
    verdict = F.coalesce("ruled", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict")
    made = ("host", "path", "rule", "verdict", "score")
    return named.select(*[F.col("row")[c].alias(c) for c in pages.columns if c not in made], "host", "path", "rule", verdict, "score")
