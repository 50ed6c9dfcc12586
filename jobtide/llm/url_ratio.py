"""URL filter by a ratio of two character language models, with DataFrame functions alone.

A short list of rules judges what it can. Two variable-order Markov models, one of the URLs that the rules
allow and one of those they block, judge the rest. A model gives the next character after the last three; each
context length is smoothed into the next shorter one by Witten and Bell's rule, so contexts that were not seen
leave the say to shorter ones. A URL's score is the difference of the two log likelihoods over its number of
characters, and the cut-off is calibrated on rule-judged URLs held out from counting: the score with the largest
sum of both classes' rates of right verdicts.

Characters are folded to 32 symbols (letters, one for all digits, `.`, `-`, `/`, one for everything else), so both
models together are one array of 32^4 differences whatever the input: 8 MB that each task holds, read by position.
Counting adds up per task before the shuffle; a hot host or a URL repeated often is only a larger count.

Defined cases: a null URL, or one without `://`, has empty host and path and matches no rule; null and empty
URLs score 0. Without URLs of both classes every score is 0 and the cut-off is 0: what no rule blocks is
allowed. Rows that repeat count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import settle

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Position in this string is the symbol's number; 0 stands for any other character and for what is before the first.
ALPHABET = "?" + LETTERS + "0.-/:"
SYMBOLS = 32
CONTEXT = 3


@dataclass(frozen=True)
class UrlRules:
    """rules: host and path prefix, then allow or block. Scores are calibrated in steps of 1 / steps nat."""

    rules: tuple[tuple[str, str], ...] = (
        ("com/", "allow"),
        ("example.com/en/", "block"),
        ("www.example.com/en/", "allow"),
        ("net/es/", "block"),
        ("net/fr/", "block"),
    )
    held_out: int = 5
    steps: int = 64
    widest: float = 8.0


def lower_ascii(text: Column) -> Column:
    return F.translate(text, LETTERS.upper(), LETTERS)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: UrlRules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does. The rules are a short reviewed list."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules.rules, key=lambda r: len(r[0])):
        rule_host, rule_path = text.split("/", 1)
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def symbols(url: Column) -> Column:
    """A URL as an array of symbol numbers."""
    folded = F.translate(lower_ascii(F.coalesce(url, F.lit(""))), "123456789", "000000000")
    plain = F.regexp_replace(folded, r"(?s)[^a-z0.\-/:]", "?")
    return F.when(F.length(plain) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(plain, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    )


def grams(codes: Column) -> Column:
    """Each symbol with the three before it, as one number below 32^4."""
    zero = F.lit(0)
    laid = F.arrays_zip(
        F.concat(F.array(zero, zero, zero), codes).alias("a"), F.concat(F.array(zero, zero), codes).alias("b"), F.concat(F.array(zero), codes).alias("c"), codes.alias("d")
    )
    number = lambda x: ((x["a"] * SYMBOLS + x["b"]) * SYMBOLS + x["c"]) * SYMBOLS + x["d"]
    return F.transform(F.filter(laid, lambda x: x["d"].isNotNull()), number)


def model(labelled: DataFrame) -> DataFrame:
    """One row, one array: by gram number, log likelihood as accepted less log likelihood as rejected.

    `labelled` has codes (symbol numbers) and verdict. Every gram number has an entry, so the array's size is fixed.
    """
    seen = labelled.select("verdict", F.explode(grams(F.col("codes"))).alias("gram")).groupBy("gram").agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    )
    classes = ("allow", "block")
    spark = labelled.sparkSession
    counts = settle(seen)

    def order(length: int) -> DataFrame:
        """Counts of the last `length` symbols, with each context's total and number of different followers."""
        modulus = SYMBOLS**length
        per = counts.groupBy((F.col("gram") % modulus).alias("gram")).agg(*[F.sum(c).alias(c) for c in classes])
        contexts = per.groupBy(F.floor(F.col("gram") / SYMBOLS).alias("context")).agg(
            *[F.sum(c).alias(f"{c}_total") for c in classes], *[F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in classes]
        )
        full = spark.range(modulus).select(F.col("id").cast("int").alias("gram"), F.floor(F.col("id") / SYMBOLS).alias("context"))
        return full.join(per, "gram", "left").join(contexts, "context", "left").drop("context").na.fill(0)

    likely = order(1).select(
        "gram", *[((F.col(c) + 1.0) / (F.col(f"{c}_total") + float(SYMBOLS))).alias(c) for c in classes]
    )
    for length in range(2, CONTEXT + 2):
        shorter = likely.select(F.col("gram").alias("tail"), *[F.col(c).alias(f"{c}_shorter") for c in classes])
        wider = order(length).join(shorter, F.col("gram") % SYMBOLS ** (length - 1) == F.col("tail"))
        smoothed = [
            F.when(F.col(f"{c}_total") == 0, F.col(f"{c}_shorter")).otherwise(
                (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_shorter")) / (F.col(f"{c}_total") + F.col(f"{c}_kinds"))
            ).alias(c)
            for c in classes
        ]
        likely = settle(wider.select("gram", *smoothed))
    ratio = likely.select(F.floor(F.col("gram") / SYMBOLS**2).alias("part"), "gram", F.log(F.col("allow") / F.col("block")).alias("ratio"))
    parts = ratio.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("gram", "ratio"))).alias("entries"))
    ordered = parts.select("part", F.col("entries.ratio").alias("ratios")).agg(F.array_sort(F.collect_list(F.struct("part", "ratios"))).alias("parts"))
    return ordered.select(F.flatten(F.col("parts.ratios")).alias("ratios"))


def score(codes: Column, ratios: Column, length: Column) -> Column:
    """The mean difference of log likelihoods over a URL's characters, one symbol each.

    codes and ratios stand here once only, so that Spark folds their projections into this one: as a column of its
    own the array would be copied for every row.
    """
    state = F.struct(F.lit(0).alias("context"), F.lit(0.0).alias("sum"))

    def step(s: Column, code: Column) -> Column:
        gram = s["context"] * SYMBOLS + code
        return F.struct((gram % SYMBOLS**CONTEXT).alias("context"), (s["sum"] + F.get(ratios, gram)).alias("sum"))

    return F.aggregate(codes, state, step, lambda s: s["sum"]) / F.greatest(length, F.lit(1))


def cut_off(scored: DataFrame, rules: UrlRules) -> DataFrame:
    """One row, one number: the score from which on a URL is allowed. `scored` has score and verdict.

    Scores fall into a fixed number of steps; the cut lies at a step's lower end, the lowest of equally good ones.
    """
    limit = rules.widest
    bin_ = F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), F.col("score"))) * rules.steps).cast("int")
    bins = scored.groupBy(bin_.alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    )
    below, whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    right = 1 - F.coalesce(F.sum("allow").over(below), F.lit(0)) / F.sum("allow").over(whole) + F.coalesce(F.sum("block").over(below), F.lit(0)) / F.sum("block").over(whole)
    totals = (F.sum("allow").over(whole) > 0) & (F.sum("block").over(whole) > 0)
    best = bins.withColumn("right", F.when(totals, right)).agg(F.max_by("bin", F.struct("right", -F.col("bin"))).alias("bin"), F.max("right").alias("right"))
    return best.select(F.when(F.col("right").isNull(), F.lit(0.0)).otherwise(F.col("bin") / float(rules.steps)).alias("cut"))


def judge_urls(pages: DataFrame, rules: UrlRules = UrlRules()) -> DataFrame:
    """page_id, host, path, rule, score, verdict of every row of `pages` (page_id, url)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parted = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parted.withColumns({"rule": rule, "rule_verdict": says, "codes": symbols(F.col("url")), "length": F.char_length(F.coalesce(F.col("url"), F.lit("")))})
    held = F.pmod(F.crc32(F.coalesce(F.col("url"), F.lit("")).cast("binary")), F.lit(rules.held_out)) == 0
    labelled = judged.where("rule_verdict is not null").select("codes", "length", F.col("rule_verdict").alias("verdict"), held.alias("held"))
    ratios = settle(model(labelled.where("not held")))
    one = ratios.select("ratios").scalar()
    # The array is a column first because a subquery may not stand inside a higher-order function; Spark folds it in.
    checked = labelled.where("held").withColumn("ratios", one).select("verdict", score(F.col("codes"), F.col("ratios"), F.col("length")).alias("score"))
    cut = settle(cut_off(checked, rules)).select("cut").scalar()
    scored = judged.withColumn("ratios", one).select("page_id", "host", "path", "rule", "rule_verdict", score(F.col("codes"), F.col("ratios"), F.col("length")).alias("score"))
    by_method = F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select("page_id", "host", "path", "rule", "score", F.coalesce("rule_verdict", by_method).alias("verdict"))
