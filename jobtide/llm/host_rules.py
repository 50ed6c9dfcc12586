"""Host-level quality rules, with DataFrame functions alone.

Each document is held against rules on its own words. Failures are added up per host (`source`) before any
shuffle, and the host's failure rate is shrunk towards that of all hosts: the rates are taken to follow a beta
distribution whose two parameters come from their mean and their variance less what sampling alone adds to it
(moments), so a host with few documents is judged mostly by the others and a large one by itself.

A host has one of two verdicts against it. One whose shrunk rate is above `host_rate` is rejected: all its documents
go. One is suspect when its rate is above the common one for all but certain, that is when the lower bound of its
posterior, `bound` standard deviations below the shrunk rate, lies above the prior's mean: of its documents those go that
fail any rule, while other hosts' documents go only if they fail the base rules. A document that fails no rule stays
unless its host is rejected.

A document's figures come from array functions on its own row: nothing of a text is shuffled, and the narrow
figures are written once before they are added up and joined back. A host with a third of all rows is a few
partial sums, and its documents' join is dealt out by adaptive execution.

Defined cases: a null or blank text has no words and fails; a null source is a host of its own; an empty table
gives no rows. Repeated rows count as often as they occur. When rates vary no more than sampling explains, or every
host has a single document, hosts are shrunk wholly to the common rate and none is suspect.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import BLANKS, native_words, settle

SYMBOLS = "#*$%&|<>"
#: Rates that vary less are equal but for rounding.
LEAST_VARIANCE = 1e-12
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


@dataclass(frozen=True)
class HostRules:
    """The base rules bind; the others count for the host, and bind in suspect hosts. Shares are parts of 1."""

    min_words: int = 50
    max_repeat_share: float = 0.5
    max_symbols_per_word: float = 0.1
    max_dup_line_share: float = 0.3
    mean_word_chars: tuple[float, float] = (2.0, 12.0)
    host_rate: float = 0.5
    bound: float = 2.0


def _bytes_of(text: Column, characters) -> Column:
    """How often single-byte characters occur."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in characters), F.lit(0)).cast("long")


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of every three-word window."""
    places = F.sequence(F.lit(1), F.size(words) - 2)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) >= 3, hashes).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(hashes: Column) -> Column:
    """Words within windows that occur at least twice; only a text that has equal windows is looked at closer.

    Its (hash, place) pairs are sorted and laid beside the pair before and after; the places of those with an equal
    neighbour are put in order, and each adds the words up to the next one, three at most.
    """
    pairs = F.array_sort(F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(1), F.size(hashes)).alias("p")))
    none = F.array(F.lit(None).cast("struct<h:bigint,p:int>"))
    before, after = F.concat(none, pairs), F.concat(F.slice(pairs, F.lit(2), F.size(hashes)), none)
    beside = F.filter(
        F.arrays_zip(pairs.alias("now"), before.alias("before"), after.alias("after")),
        lambda x: (x["now"]["h"] == x["before"]["h"]) | (x["now"]["h"] == x["after"]["h"]),
    )
    at = F.array_sort(F.transform(beside, lambda x: x["now"]["p"]))
    state = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    words = F.aggregate(
        at, state, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).cast("long").alias("n")), lambda s: s["n"]
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(words)


def figures(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, fails (any rule)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    split = docs.select("doc_id", "source", "text").withColumn("words", native_words(F.col("text")))
    hashed = split.withColumn("hashes", _window_hashes(F.col("words")))
    counted = hashed.select(
        "doc_id",
        "source",
        F.size("words").cast("long").alias("n_words"),
        (F.char_length(text) - _bytes_of(text, WHITE)).cast("long").alias("word_chars"),
        _bytes_of(text, SYMBOLS).alias("n_symbols"),
        lines.alias("lines"),
        _repeat_words(F.col("hashes")).alias("n_repeat_words"),
    ).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    mean_chars = F.col("word_chars") / per_word
    low, high = rules.mean_word_chars
    base_failed = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") > rules.max_repeat_share * F.col("n_words"))
    return counted.withColumn("base_failed", base_failed).select(
        "doc_id",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (
            F.col("base_failed")
            | (F.col("n_symbols") > rules.max_symbols_per_word * per_word)
            | (F.col("n_dup_lines") > rules.max_dup_line_share * F.greatest(F.size("lines"), F.lit(1)))
            | (mean_chars < low)
            | (mean_chars > high)
        ).alias("fails"),
    )


def host_verdicts(judged: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """source, docs, failed, host_rate, host_low (lower bound of its posterior), host_kept, host_suspect.

    Raw rates of hosts with n documents have the variance v + (m (1 - m) - v) / n on average, m and v being mean and
    variance of the true ones; v follows from the variance seen and the mean of 1 / n. A beta distribution with mean m
    and variance v has strength m (1 - m) / v - 1, and a host with k failures has the rate (k + strength m) / (n + strength).
    """
    hosts = judged.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("fails").cast("long")).alias("failed"))
    hosts = hosts.withColumn("rate", F.col("failed") / F.col("docs"))
    prior = hosts.agg(F.avg("rate").alias("m"), F.var_samp("rate").alias("seen"), F.avg(1 / F.col("docs")).alias("single"))
    true_variance = (F.col("seen") - F.col("m") * (1 - F.col("m")) * F.col("single")) / (1 - F.col("single"))
    prior = prior.select("m", F.when(F.col("single") < 1, true_variance).alias("v"))
    # One row of two numbers, looked up as a scalar.
    mean, variance = prior.select("m").scalar(), prior.select("v").scalar()
    hosts = hosts.withColumn("m", mean).withColumn("v", variance)
    strength = F.greatest(F.lit(0.0), F.col("m") * (1 - F.col("m")) / F.col("v") - 1)
    vary = F.col("v") > LEAST_VARIANCE
    hosts = hosts.withColumn("strength", F.when(vary, strength))
    shrunk = (F.col("failed") + F.col("strength") * F.col("m")) / (F.col("docs") + F.col("strength"))
    hosts = hosts.withColumn("host_rate", F.when(vary, shrunk).otherwise(F.col("m")))
    spread = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("docs") + F.col("strength") + 1))
    low = F.when(vary, F.col("host_rate") - rules.bound * spread).otherwise(F.col("m"))
    return hosts.withColumn("host_low", low).select(
        "source", "docs", "failed", "host_rate", "host_low", (F.col("host_rate") <= rules.host_rate).alias("host_kept"), (F.col("host_low") > F.col("m")).alias("host_suspect")
    )


def judge(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """The figures of every document, its host's rate, and `kept`."""
    judged = settle(figures(docs, rules))
    hosts = host_verdicts(judged, rules).select(F.col("source").alias("host"), "host_rate", "host_kept", "host_suspect")
    joined = judged.join(hosts, F.col("source").eqNullSafe(F.col("host"))).drop("host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_kept") & ~(F.col("host_suspect") & F.col("fails")))
